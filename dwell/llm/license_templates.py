"""Licence notices to look for. Wordings that publishers use."""

TEMPLATES: dict[str, str] = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "mit-line": "Released under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS
        IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
        TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
        THE POSSIBILITY OF SUCH DAMAGE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
        "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
        OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
        THIS SOFTWARE.""",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version.""",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
        for any purpose, commercial or non-commercial, and by any means.""",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-4.0-line": "Licensed under CC BY-ND 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "spdx": "SPDX-License-Identifier:",
    "all-rights-reserved": "All rights reserved.",
}

#: The notices of the GNU family: name, whole name in words, version.
GNU = (
    ("gpl-2.0", "GNU General Public License", "2"), ("gpl-3.0", "GNU General Public License", "3"), ("lgpl-2.1", "GNU Lesser General Public License", "2.1"),
    ("lgpl-3.0", "GNU Lesser General Public License", "3"), ("agpl-3.0", "GNU Affero General Public License", "3"),
)
for _name, _whole, _version in GNU:
    TEMPLATES.setdefault(_name, f"""This program is free software: you can redistribute it and/or modify it under the terms of the {_whole}
        as published by the Free Software Foundation, either version {_version} of the License, or (at your option) any later version.""")
    TEMPLATES.setdefault(f"{_name}-line", f"This work is licensed under the {_whole}, version {_version}.")
_bsd = TEMPLATES["bsd-2-clause"]
_at = _bsd.index("THIS SOFTWARE IS")
TEMPLATES["bsd-3-clause"] = _bsd[:_at] + """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission. """ + _bsd[_at:]
CC = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial", "by-nd": "Attribution-NoDerivatives", "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}
for _kind, _whole in CC.items():
    for _version, _scope in CC_VERSIONS.items():
        TEMPLATES.setdefault(f"cc-{_kind}-{_version}-line", f"Licensed under CC {_kind.upper()} {_version}.")
        TEMPLATES.setdefault(f"cc-{_kind}-{_version}", f"This work is licensed under a Creative Commons {_whole} {_version} {_scope} License.")

#: Long notices that differ from others in a few words, without which (changed or missing) they are not reported at all.
SIBLINGS = {k: TEMPLATES.pop(k) for k in ("gpl-2.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0", "bsd-3-clause")}
#: The words that tell a licence from its siblings: each of these phrases must stand in the text, word by word as here, and be aligned.
TELLING: dict[str, tuple[str, ...]] = {
    "apache-2.0-line": ("apache license version 2.0",), "mit-line": ("mit license",), "bsd-3-clause": ("endorse or promote products",),
    **{name: (whole, f"version {version}") for name, whole, version in GNU},
    **{f"{name}-line": (whole, f"version {version}") for name, whole, version in GNU},
    **{f"cc-{k}-{v}-line": (f"CC {k} {v}",) for k in CC for v in CC_VERSIONS},
    **{f"cc-{k}-{v}": (f"Creative Commons {CC[k]} {v}",) for k in CC for v in CC_VERSIONS},
}
