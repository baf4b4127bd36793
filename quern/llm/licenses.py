"""Further licence templates, besides those of ``license_scan``: full texts,
file headers, and notices in their usual wordings. A name has several texts."""

from __future__ import annotations

from pathlib import Path

_FOLDER = Path(__file__).resolve().parent / "licenses"


def _full(name: str) -> str:
    return (_FOLDER / f"{name}.txt").read_text(encoding="utf-8")


_DISCLAIMED = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. """
_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission. """
_REGENTS = ("COPYRIGHT HOLDERS", "REGENTS"), ("COPYRIGHT HOLDER", "REGENTS"), ("copyright holder", "University")


def _regents(text: str) -> str:
    for old, new in _REGENTS:
        text = text.replace(old, new)
    return text


_GNU = """This {what} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU
{kind}General Public License as published by the Free Software Foundation{semicolon} either version {version} of the
License, or (at your option) any later version. This {what} is distributed in the hope that it will be useful, but
WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
GNU {kind}General Public License for more details."""
_RECEIVED = """ You should have received a copy of the GNU {kind}General Public License along with this {what}. If not,
see <https://www.gnu.org/licenses/>."""


def _gnu(kind: str, version: str, what: str = "program") -> list[str]:
    fill = {"kind": kind, "version": version, "what": what, "colon": ":", "semicolon": ","}
    return [_GNU.format(**fill), (_GNU + _RECEIVED).format(**fill)]


#: Section 13 and the title are what the AGPL has of its own beside its preamble.
_REMOTE = """13. Remote Network Interaction; Use with the GNU General Public License.

Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently
offer all users interacting with it remotely through a computer network (if your version supports such interaction) an
opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a
network server at no charge, through some standard or customary means of facilitating copying of software. This
Corresponding Source shall include the Corresponding Source for any work covered by version 3 of the GNU General Public
License that is incorporated pursuant to the following paragraph.

Notwithstanding any other provision of this License, you have permission to link or combine any covered work with a work
licensed under version 3 of the GNU General Public License into a single combined work, and to convey the resulting work.
The terms of this License will continue to apply to the part which is the covered work, but the work with which it is
combined will remain governed by version 3 of the GNU General Public License.

"""


def _agpl() -> str:
    text = _full("GPL-3").replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE").replace("29 June", "19 November")
    a, b = text.index("13. Use with the GNU Affero"), text.index("14. Revised Versions")
    return text[:a] + _REMOTE + text[b:].replace("GNU General", "GNU Affero General")


#: What a notice calls a licence.
CALLED = {
    "MIT": ["the MIT License", "an MIT License", "MIT License", "the MIT", "MIT"],
    "Apache-2.0": [
        "the Apache License, Version 2.0", "the Apache License 2.0", "Apache License 2.0", "the Apache 2.0 License",
        "Apache 2.0", "Apache-2.0", "the Apache License, Version 2.0 (the License)",
    ],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "BSD-3-Clause"],
    "ISC": ["the ISC License", "ISC License"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "the MPL 2.0", "MPL-2.0"],
    "Unlicense": ["the Unlicense"],
    "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "the Creative Commons Zero v1.0 Universal License"],
}
for _long, _short in (("GNU", "GPL"), ("GNU Lesser", "LGPL"), ("GNU Affero", "AGPL")):
    for _v in {"GPL": ["2", "3"], "LGPL": ["2.1", "3"], "AGPL": ["3"]}[_short]:
        _name = f"{_short}-{_v if '.' in _v else _v + '.0'}"
        CALLED[_name] = [
            f"the {_long} General Public License, version {_v}", f"the {_long} General Public License version {_v}.0",
            f"the {_long} General Public License v{_v}.0", f"the {_long} General Public License v{_v}",
            f"the {_long} {_short} v{_v}", f"the {_short} v{_v}", f"the {_short}-{_v}.0", f"{_short}v{_v}", f"the {_short}v{_v}",
        ]
for _code, _what in {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}.items():
    for _v in ("3.0", "4.0"):
        _tail = {"3.0": "Unported", "4.0": "International"}[_v]
        CALLED[f"CC-{_code}-{_v}"] = [
            f"CC {_code} {_v}", f"a CC {_code} {_v} License", f"the CC {_code} {_v} License", f"Creative Commons {_what} {_v}",
            *(f"{x} Creative Commons {_what} {_v}{y} License" for x in ("a", "the") for y in ("", f" {_tail}")),
        ]

#: How a notice begins.
OPENINGS = [
    "Licensed under", "Released under", "Distributed under",
    *(f"This {x} is {y} under" for x in ("project", "software", "work", "code") for y in ("licensed", "released")),
    "This program is licensed under", "This document is licensed under",
]
_ENDINGS = ["", " - see the LICENSE file for details"]


def _notices(name: str, called: list[str]) -> list[str]:
    ids = [name, f"{name}-only", f"{name}-or-later"] if "GPL" in name else [name]
    found = [f"SPDX-License-Identifier: {x}" for x in ids]
    found += [f"{o} {c}" for o in OPENINGS for c in called]
    return found + [f"This project is licensed under {c}{_ENDINGS[1]}" for c in called if c.startswith("the ")]


#: Name of a licence, header or notice, and its texts.
MORE: dict[str, list[str]] = {
    "BSD-2-Clause": [_BSD + _DISCLAIMED, _regents(_BSD + _DISCLAIMED)],
    "BSD-3-Clause": [_BSD + _THIRD + _DISCLAIMED, _regents(_BSD + _THIRD + _DISCLAIMED)],
    "Unlicense": [
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or
authors of this software dedicate any and all copyright interest in the software to the public domain. We make this
dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more
information, please refer to <https://unlicense.org>"""
    ],
    "MPL-2.0 header": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
    ],
    "GPL-2.0 header": [x.replace("Foundation,", "Foundation;") for x in _gnu("", "2")],
    "GPL-3.0 header": _gnu("", "3")[1:],
    "LGPL-2.1 header": _gnu("Lesser ", "2.1", "library"),
    "LGPL-3.0 header": _gnu("Lesser ", "3") + _gnu("Lesser ", "3", "library"),
    "AGPL-3.0 header": _gnu("Affero ", "3"),
    "Apache-2.0": [_full("Apache-2.0")],
    "GPL-2.0": [_full("GPL-2")],
    "GPL-3.0": [_full("GPL-3")],
    "LGPL-2.1": [_full("LGPL-2.1")],
    "LGPL-3.0": [_full("LGPL-3")],
    "AGPL-3.0": [_agpl()],
    "MPL-2.0": [_full("MPL-2.0")],
    "CC0-1.0": [_full("CC0-1.0")],
    **{f"{name} notice": _notices(name, called) for name, called in CALLED.items()},
}
