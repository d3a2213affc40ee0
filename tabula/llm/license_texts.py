"""Licence statements, notices and disclaimers that are looked for in documents, and the words that tell them apart."""

from __future__ import annotations

# Licence statements and notices; fixed values.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES "
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "mit-line": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."),
    "mit-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR "
        "IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "isc-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "bsd-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
        "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
        "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    "gpl-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "lgpl-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
        "version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    "lgpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    "agpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
    "gpl-copy-notice": "You should have received a copy of the GNU General Public License along with this program.",
    "lgpl-copy-notice": "You should have received a copy of the GNU Lesser General Public License along with this library.",
    "agpl-copy-notice": "You should have received a copy of the GNU Affero General Public License along with this program.",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "all-rights-reserved": "All rights reserved.",
    "bsd-line": "Released under the BSD License.",
    "bsd-2-clause-line": "Released under the BSD 2-Clause License.",
    "bsd-3-clause-line": "Released under the BSD 3-Clause License.",
    "isc-line": "Released under the ISC License.",
    "mpl-2.0-line": "Licensed under the Mozilla Public License, Version 2.0.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-v2-line": "This work is licensed under the GNU General Public License v2.",
    "gpl-3.0-v3-line": "This work is licensed under the GNU General Public License v3.",
    "lgpl-2.1-line": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "cc-by-4.0-short-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-sa-4.0-long-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0-long-line": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-4.0-line": "Licensed under CC BY-ND 4.0.",
    "cc-by-nd-4.0-long-line": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa-4.0-line": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-sa-4.0-long-line": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-4.0-line": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-nc-nd-4.0-long-line": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "cc0-1.0-line": "Released under CC0 1.0 Universal.",
}

# What each template must have whatever its coverage: phrases whose words are aligned and stand side by side in the text. A
# phrase after "-" belongs to another licence and must not stand in the stretch or just behind it.
MARKS = {
    "apache-2.0-line": ("apache license", "2 0"),
    "apache-2.0-notice": ("apache license", "2 0"),
    "cc-by-nc-4.0-line": ("cc by nc 4 0",),
    "cc-by-4.0-line": ("creative commons attribution 4 0",),
    "gpl-3.0-line": ("gnu general public license", "version 3"),
    "gpl-3.0-notice": ("gnu general public license", "version 3"),
    "isc": ("with or without fee", "-supporting documentation"),
    "mit-line": ("mit", "-mit 0"),
    "mit": ("to deal in the software", "-good not evil"),
    "bsd-3-clause": ("endorse or promote products", "-advertising materials"),
    "mit-disclaimer": ("authors or copyright holders",),
    "isc-disclaimer": ("disclaims all warranties",),
    "bsd-disclaimer": ("are disclaimed",),
    "bsd-2-clause": ("redistributions in binary form", "-neither the name", "-advertising materials"),
    "gpl-2.0-notice": ("gnu general public license", "version 2"),
    "lgpl-2.1-notice": ("gnu lesser general public license", "version 2 1"),
    "lgpl-3.0-notice": ("gnu lesser general public license", "version 3"),
    "agpl-3.0-notice": ("gnu affero general public license", "version 3"),
    "gpl-copy-notice": ("gnu general public license",),
    "lgpl-copy-notice": ("gnu lesser general public license",),
    "agpl-copy-notice": ("gnu affero general public license",),
    "mpl-2.0-notice": ("mozilla public license v 2 0",),
    "all-rights-reserved": ("all rights reserved",),
    "bsd-line": ("bsd license",),
    "bsd-2-clause-line": ("bsd 2 clause",),
    "bsd-3-clause-line": ("bsd 3 clause",),
    "isc-line": ("isc",),
    "mpl-2.0-line": ("mozilla public license", "2 0"),
    "gpl-2.0-line": ("gnu general public license", "version 2"),
    "gpl-2.0-v2-line": ("gnu general public license", "v2"),
    "gpl-3.0-v3-line": ("gnu general public license", "v3"),
    "lgpl-2.1-line": ("gnu lesser general public license", "version 2 1"),
    "lgpl-3.0-line": ("gnu lesser general public license", "version 3"),
    "agpl-3.0-line": ("gnu affero general public license", "version 3"),
    "cc-by-4.0-short-line": ("cc by 4 0",),
    "cc-by-sa-4.0-line": ("cc by sa 4 0",),
    "cc-by-sa-4.0-long-line": ("creative commons attribution sharealike 4 0",),
    "cc-by-nc-4.0-long-line": ("creative commons attribution noncommercial 4 0",),
    "cc-by-nd-4.0-line": ("cc by nd 4 0",),
    "cc-by-nd-4.0-long-line": ("creative commons attribution noderivatives 4 0",),
    "cc-by-nc-sa-4.0-line": ("cc by nc sa 4 0",),
    "cc-by-nc-sa-4.0-long-line": ("creative commons attribution noncommercial sharealike 4 0",),
    "cc-by-nc-nd-4.0-line": ("cc by nc nd 4 0",),
    "cc-by-nc-nd-4.0-long-line": ("creative commons attribution noncommercial noderivatives 4 0",),
    "cc0-1.0-line": ("cc0 1 0",),
}
