"""License notices as they are published, by SPDX name, and the words that tell a notice from its like."""

_GNU = (
    "{who} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the Free"
    " Software Foundation{sign} either version {number} of the License, or (at your option) any later version. {who} is distributed in the hope that it will be"
    " useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}"
    " Public License for more details."
)
GNU = [
    (f"{name}-{version}-or-later", _GNU.format(who=who, mark=mark, sign=sign, kind=kind, number=version.removesuffix(".0")), f"GNU {kind} Public License as published by the Free Software Foundation either version {version.removesuffix('.0')}")
    for name, kind, version, who, mark, sign in [
        ("AGPL", "Affero General", "3.0", "This program", ":", ","),
        ("GPL", "General", "2.0", "This program", ";", ";"),
        ("GPL", "General", "3.0", "This program", ":", ","),
        ("LGPL", "Lesser General", "2.1", "This library", ";", ";"),
        ("LGPL", "Lesser General", "3.0", "This library", ":", ","),
    ]
]
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"
    " and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"
    " without specific prior written permission. "
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE'
    " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE"
    " FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR"
    " TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_TAIL = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS'
    " FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER"
    " IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)

TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy'
        " of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under"
        ' the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the'
        " specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Attribution 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "CC BY 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Attribution-NonCommercial 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "CC BY-NC 4.0"),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "NonCommercial-NoDerivatives 4.0"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0.", "CC BY-NC-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "NonCommercial-ShareAlike 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0.", "CC BY-NC-SA 4.0"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "Attribution-NoDerivatives 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0.", "CC BY-ND 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Attribution-ShareAlike 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "CC BY-SA 4.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "GNU General Public License version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "GNU General Public License version 3"),
    *GNU,
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above"
        ' copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD'
        " TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    ("MIT", "Released under the MIT License.", "MIT License"),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to'
        " deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or"
        " sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright"
        " notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "without restriction",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can"
        " obtain one at http://mozilla.org/MPL/2.0/.",
        "Mozilla Public License",
    ),
    ("Proprietary", "All rights reserved.", "All rights reserved"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
TEMPLATES += [
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL, "Redistributions in binary form"),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL, "Neither the name of"),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"
        " https://www.eclipse.org/legal/epl-2.0/",
        "Eclipse Public License 2.0",
    ),
    ("MIT", next(text for name, text, *_ in TEMPLATES if name == "MIT" and len(text) > 99) + _MIT_TAIL, "without restriction"),
]
SPDX = [
    "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0",
    "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only",
    "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0",
    "Unlicense", "Zlib",
]
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}", f"SPDX-License-Identifier {name}") for name in SPDX]
