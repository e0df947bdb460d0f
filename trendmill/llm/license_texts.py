"""Texts and notices of public licences, keyed by their short identifiers.

A key may occur with several texts: the licence itself, and notices that stand for it. Line breaks, case,
punctuation and copyright lines do not matter. Long licences are kept whole in ``license_files``, named by their key.
"""

from importlib.resources import files

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. "
)
_ZERO_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted. "
)
_ISC_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

_SHORT = (
    ("MIT", "MIT License " + _MIT_GRANT),
    ("MIT", _MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("ISC", "ISC License " + _ISC_GRANT + _ISC_DISCLAIMER),
    ("ISC", _ISC_GRANT + _ISC_DISCLAIMER),
    ("ISC", "Licensed under the ISC License."),
    ("0BSD", _ZERO_GRANT + _ISC_DISCLAIMER),
    ("BSD-2-Clause", _BSD_TWO + _BSD_DISCLAIMER),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", _BSD_TWO + _BSD_THIRD + _BSD_DISCLAIMER),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
     "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
     "for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0-only", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0-only", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("MPL-2.0",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "Released under the CC0 1.0 Universal License."),
)

# Titles that stand above the texts of a licence.
_TITLES = {
    "MIT": ("The MIT License (MIT)", "The MIT License", "MIT License (MIT)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License"),
}
_BODIES = {"MIT": _MIT_GRANT, "BSD-2-Clause": _BSD_TWO + _BSD_DISCLAIMER, "BSD-3-Clause": _BSD_TWO + _BSD_THIRD + _BSD_DISCLAIMER}
# Identifiers that a line may name, besides those that have texts here.
_IDENTIFIERS = (
    "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later",
    "BSL-1.0", "EPL-2.0", "Unlicense", "Zlib",
)
# Names and versions of the licences with a choice of later versions.
_GNU = (("GPL", "General", "2"), ("GPL", "General", "3"), ("LGPL", "Lesser General", "2.1"), ("LGPL", "Lesser General", "3"),
        ("AGPL", "Affero General", "3"))
# Behind this line some licences show how to apply them; many copies end here.
_LAST_LINE = "END OF TERMS AND CONDITIONS"


def _bulleted(text: str) -> str:
    """Clauses with bullets, which count as punctuation, in place of numbers."""
    for number in ("1. ", "2. ", "3. "):
        text = text.replace(number, "* ")
    return text


def _or_later(key: str, name: str, version: str) -> list[tuple[str, str]]:
    key = f"{key}-{version}" + ("" if "." in version else ".0") + "-or-later"
    return [(key, f"{verb} under the GNU {name} Public License, version {version} or {later}.")
            for verb in ("Licensed", "Released") for later in ("later", "any later version", "(at your option) any later version")]


def _all_known() -> tuple[tuple[str, str], ...]:
    known = list(_SHORT)
    for key, body in _BODIES.items():
        for form in (body, _bulleted(body)):
            known += [(key, form), *[(key, f"{title} {form}") for title in _TITLES[key]]]
    for file in sorted(files(__package__).joinpath("license_files").iterdir(), key=lambda f: f.name):
        key, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        known.append((key, text))
        if _LAST_LINE in text:
            known.append((key, text[:text.index(_LAST_LINE) + len(_LAST_LINE)]))
    for gnu in _GNU:
        known += _or_later(*gnu)
    keys = [*dict.fromkeys(key for key, _ in known), *_IDENTIFIERS]
    known += [(key, f"SPDX-License-Identifier: {key}") for key in dict.fromkeys(keys)]
    return tuple(dict.fromkeys(known))


KNOWN = _all_known()
