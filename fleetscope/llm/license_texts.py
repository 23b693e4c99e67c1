"""Notices of common public licences, and the phrases of the base scan.

Fixed values: the wording is that of the licences' own published notices.
A template may stand for a part of a licence's text; placeholders (year,
holder) are left out.
"""

from __future__ import annotations

# Words that stand consecutively -> label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution."""
_GNU_TAIL = """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."""


def _gnu(name: str, version: str) -> str:
    return (f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free "
            f"Software Foundation, either version {version} of the License, or (at your option) any later version. {_GNU_TAIL.format(name=name)}")


def _creative(names: str, code: str) -> list[str]:
    return [f"This work is licensed under a Creative Commons {names} 4.0 International License.",
            f"This work is licensed under the Creative Commons {names} 4.0 International License.",
            f"Licensed under CC {code} 4.0.", f"This work is licensed under CC {code} 4.0."]


TEMPLATES: dict[str, list[str]] = {
    "agpl-3.0": [_gnu("GNU Affero General Public License", "3")],
    "apache-2.0": [
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
        obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express
        or implied. See the License for the specific language governing permissions and limitations under the License.""",
        "Licensed under the Apache License, Version 2.0."],
    "bsd-2-clause": [_BSD_HEAD],
    "bsd-3-clause": [_BSD_HEAD + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission."""],
    "bsl-1.0": ["""Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
        documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to
        prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"""],
    "cc-by-4.0": _creative("Attribution", "BY"),
    "cc-by-nc-4.0": _creative("Attribution-NonCommercial", "BY-NC"),
    "cc-by-nc-nd-4.0": _creative("Attribution-NonCommercial-NoDerivatives", "BY-NC-ND"),
    "cc-by-nc-sa-4.0": _creative("Attribution-NonCommercial-ShareAlike", "BY-NC-SA"),
    "cc-by-nd-4.0": _creative("Attribution-NoDerivatives", "BY-ND"),
    "cc-by-sa-4.0": _creative("Attribution-ShareAlike", "BY-SA"),
    "gpl-2.0": [_gnu("GNU General Public License", "2"), "This work is licensed under the GNU General Public License, version 2."],
    "gpl-3.0": [_gnu("GNU General Public License", "3"), "This work is licensed under the GNU General Public License, version 3."],
    "isc": ["""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
        that the above copyright notice and this permission notice appear in all copies."""],
    "lgpl-2.1": [_gnu("GNU Lesser General Public License", "2.1")],
    "lgpl-3.0": [_gnu("GNU Lesser General Public License", "3")],
    "mit": [
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
        "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
        the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions
        of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
        BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "Released under the MIT License.", "Licensed under the MIT License."],
    "mpl-2.0": ["""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""],
    "unlicense": ["""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means."""],
    "zlib": ["""This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
        damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely"""],
}
