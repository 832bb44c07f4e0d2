from pagelathe.llm.licenses import scan_licenses

MIT = '''Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
'''


def scan(documents, *texts):
    docs = documents(*[(i, t, "s") for i, t in enumerate(texts)])
    return [tuple(r)[1:] for r in sorted(scan_licenses(docs).collect())]


def test_rules_need_their_sentences_in_order(documents):
    grant, notice = MIT.split("\n\n")[1:3]
    found = scan(
        documents,
        MIT,
        f"{notice}\n\n{grant}",
        "Prose. Licensed under CC BY-NC 4.0. More prose",
        "no stop at the end\nReleased under the MIT License.\nAll rights reserved.",
        "We licensed under the Apache License, Version 2.0 a lot",
        "Licensed under the Apache License, Version 2.0.",
    )
    assert found == [
        ("MIT", "MITGrant,MITNotice,MITAsIs,MITLiability", ""),
        ("", "MITNotice,MITGrant", "MITNotice,MITGrant"),
        ("CC-BY-NC-4.0", "CCBYNCRef", ""),
        ("LicenseRef-AllRightsReserved,MIT", "MITRef,Reserved", ""),
        ("", "", ""),
        ("Apache-2.0", "ApacheRef", ""),
    ]


def test_odd_rows(odd):
    found = scan_licenses(odd).collect()
    assert len(found) == 13 and {tuple(r)[1:] for r in found} == {("", "", "")}
    assert scan_licenses(odd.limit(0)).count() == 0


APACHE = '''Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
'''
GPL = '''This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
'''
BSD = '''Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
'''
NAMES = '''
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
'''
MPL = '''This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
'''
NOTICES = [
    ("Apache-2.0", "ApacheHead,ApacheUse,ApacheCopy,ApacheAsIs,ApacheSee", APACHE),
    ("MIT", "MITTitle,MITGrant,MITNotice,MITAsIs,MITLiability", "MIT License\n\n" + MIT.split("\n\n", 1)[1]),
    ("GPL-3.0-or-later", "GPL3PlusGrant,GPLAsIs,GPLSee", GPL.format(":", ",", 3)),
    ("GPL-2.0-or-later", "GPL2PlusGrant,GPLAsIs,GPLSee", GPL.format(";", ";", 2)),
    ("BSD-2-Clause", "BSDGrant,BSDSource,BSDBinary", BSD),
    ("BSD-3-Clause", "BSDGrant,BSDSource,BSDBinary,BSDNames", BSD + NAMES),
    ("MPL-2.0", "MPLHead", MPL),
    ("GPL-3.0-only", "GPL3Ref", "Licensed under the GNU General Public License,\nversion 3.\n"),
    ("GPL-3.0-only", "GPL3Ref", "This work is licensed under the GNU General Public License, version\n3. More of it.\n"),
    ("CC-BY-4.0", "CCBYRef", "This work is licensed under a Creative Commons\nAttribution 4.0 International License.\n"),
    ("CC-BY-4.0", "CCBYRef", "Licensed under CC BY 4.0.\n"),
    ("CC-BY-SA-4.0", "CCBYSARef", "Licensed under CC BY-SA 4.0.\n"),
    ("CC-BY-NC-4.0", "CCBYNCRef", "Licensed under CC\nBY-NC 4.0.\n"),
    ("MIT", "MITRef", "This work is licensed under the MIT\nLicense.\n"),
    ("Apache-2.0", "ApacheRef", "Licensed under the Apache License,\nVersion 2.0\n"),
    ("LicenseRef-AllRightsReserved", "Reserved", "Copyright (c) 2020 Somebody\nAll rights reserved.\n"),
]


def test_canonical_notices(documents):
    """As printed, in comments of several kinds, on one line, with Windows line ends."""
    ways = [
        lambda n: n,
        lambda n: "/*\n" + "".join(f" * {x}".rstrip() + "\n" for x in n.splitlines()) + " */\nint main() { return 0; }\n",
        lambda n: "#!/bin/sh\n#\n" + "".join(f"# {x}".rstrip() + "\n" for x in n.splitlines()) + "\nset -e\n",
        lambda n: "".join(f"// {x}\n" for x in n.splitlines()),
        lambda n: "<!--\n" + n + "-->\n<p>",
        # On one line a title has no end.
        lambda n: n if n.startswith(("MIT License", "Copyright")) else " ".join(n.split()),
        lambda n: n.replace("\n", "\r\n"),
        lambda n: "Some prose before it\n\n" + n + "\nSome prose after it",
    ]
    texts = [way(n) for way in ways for _, _, n in NOTICES]
    assert scan(documents, *texts) == [(name, ids, "") for _ in ways for name, ids, _ in NOTICES]


def test_words_inside_other_sentences_are_no_notice(documents):
    texts = ["Licensed under the MIT License\nwas the wish of some.", "They said all rights reserved\nis no licence.", "1. Redistributions of source code.", "Licensed under the\n\nApache. License, Version 2.0."]
    assert scan(documents, *texts) == [("", "", "")] * 4
