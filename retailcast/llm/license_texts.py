"""Licence templates: full texts, standard notices and one-line statements, with the words that must be in them."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values: licence texts, notices, names and versions ----
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
MIT_GRANT = MIT[:MIT.index("THE SOFTWARE IS PROVIDED")]
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
ISC_REST = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in
binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution."""
BSD_ENDORSE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission."""
BSD_REST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED
TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""
APACHE_TEXT = """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"""
APACHE_GRANT = """Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual,
worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly
perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at"""
UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising
from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions"""
BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation
covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of
the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following"""
CC0_NOTICE = """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."""
CC0_TEXT = """Creative Commons Legal Code CC0 1.0 Universal"""
CC_TEXT = """By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons
{name} {version} International Public License ("Public License")."""
GNU_NOTICE = """This {what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software
Foundation, either version {version} of the License, or (at your option) any later version."""
GNU_TEXT = """{name} Version {version}, {date} Copyright (C) {years} Free Software Foundation, Inc."""
#: name, full name, version, date and years of the text, short name, what the notice calls the work.
GNU = [("GPL-2.0", "GNU General Public License", "2", "June 1991", "1989, 1991", "GPL", "program"),
       ("GPL-3.0", "GNU General Public License", "3", "29 June 2007", "2007", "GPL", "program"),
       ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "February 1999", "1991, 1999", "LGPL", "library"),
       ("LGPL-3.0", "GNU Lesser General Public License", "3", "29 June 2007", "2007", "LGPL", "library"),
       ("AGPL-3.0", "GNU Affero General Public License", "3", "19 November 2007", "2007", "AGPL", "program")]
CC = [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
      ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]
CC_VERSIONS = [("2.0", "Generic"), ("3.0", "Unported"), ("4.0", "International")]
#: Licences that a one-line statement names: (licence, name, words that must be there).
NAMED = [("Apache-2.0", "the Apache License, Version 2.0", ["apache", "2.0"]), ("Apache-2.0", "the Apache License 2.0", ["apache", "2.0"]),
         ("Apache-2.0", "Apache 2.0", ["apache 2.0"]), ("MIT", "the MIT License", ["mit license"]), ("MIT", "MIT", ["mit"]),
         ("ISC", "the ISC License", ["isc license"]), ("BSD-2-Clause", "the BSD 2-Clause License", ["bsd 2 clause"]),
         ("BSD-2-Clause", "the 2-clause BSD license", ["2 clause bsd"]), ("BSD-3-Clause", "the BSD 3-Clause License", ["bsd 3 clause"]),
         ("BSD-3-Clause", "the 3-clause BSD license", ["3 clause bsd"]), ("MPL-2.0", "the Mozilla Public License, version 2.0", ["mozilla public license", "2.0"]),
         ("MPL-2.0", "the Mozilla Public License 2.0", ["mozilla public license 2.0"]), ("Zlib", "the zlib License", ["zlib"]),
         ("BSL-1.0", "the Boost Software License, Version 1.0", ["boost software license", "1.0"]), ("Unlicense", "the Unlicense", ["unlicense"]),
         ("CC0-1.0", "CC0 1.0", ["cc0 1.0"]), ("CC0-1.0", "the CC0 1.0 Universal Public Domain Dedication", ["cc0 1.0"])]
STATEMENTS = ["Licensed under {}.", "Released under {}.", "Distributed under {}.", "This work is licensed under {}.", "This software is released under {}.",
              "This project is licensed under {}.", "This project is licensed under the terms of {}.", "Made available under the terms of {}.",
              "This code is distributed under the terms of {}."]
# ----


@dataclass
class Template:
    """``must``: word sequences that a window must hold (each entry: alternatives); ``never``: ones that rule it out."""

    license: str
    text: str
    must: list[list[str]]
    never: list[str] = field(default_factory=list)


def gnu_versions(version: str) -> list[str]:
    return [f"version {version}", f"v{version}", f"v {version}", f"version {version}.0" if "." not in version else f"version {version}",
            f"v{version}.0" if "." not in version else f"v{version}"]


def templates() -> list[Template]:
    out = [Template("MIT", MIT, [["permission is hereby granted free of charge"]]), Template("MIT", MIT_GRANT, [["to deal in the software without restriction"]]),
           Template("ISC", ISC, [["with or without fee"]]), Template("ISC", f"{ISC} {ISC_REST}", [["with or without fee"]]),
           Template("BSD-2-Clause", f"{BSD_2} {BSD_REST}", [["redistribution and use in source and binary forms"]], ["endorse or promote", "advertising materials"]),
           Template("BSD-3-Clause", f"{BSD_2} {BSD_ENDORSE} {BSD_REST}", [["redistribution and use in source and binary forms"], ["endorse or promote"]], ["advertising materials"]),
           Template("BSD-3-Clause", f"{BSD_2} {BSD_ENDORSE}", [["redistribution and use in source and binary forms"], ["endorse or promote"]], ["advertising materials"]),
           Template("Apache-2.0", APACHE_NOTICE, [["apache license"], ["version 2.0"]]), Template("Apache-2.0", APACHE_TEXT, [["apache license"], ["version 2.0"]]),
           Template("Apache-2.0", APACHE_GRANT, [["grant of copyright license"]]), Template("MPL-2.0", MPL_NOTICE, [["mozilla public license"], ["v 2.0", "version 2.0"]]),
           Template("Unlicense", UNLICENSE, [["free and unencumbered software"]]), Template("Zlib", ZLIB, [["in no event will the authors be held liable"]]),
           Template("BSL-1.0", BOOST, [["any person or organization"]]), Template("CC0-1.0", CC0_NOTICE, [["waived all copyright"]]),
           Template("CC0-1.0", CC0_TEXT, [["cc0 1.0 universal"]])]
    named = [(name, phrase, [[m] for m in must]) for name, phrase, must in NAMED]
    for name, long, version, date, years, short, what in GNU:
        must = [[long.lower()], gnu_versions(version)]
        out.append(Template(name, GNU_NOTICE.format(what=what, name=long, version=version), must))
        out.append(Template(name, GNU_TEXT.format(name=long, version=version, date=date, years=years), must))
        named += [(name, f"the {long}, version {version}", must), (name, f"the {long} v{version}", must),
                  (name, f"the {short} version {version}", [[short.lower()], gnu_versions(version)]), (name, f"the {short}v{version}", [[f"{short}v{version}".lower()]])]
    for code, long in CC:
        for version, port in CC_VERSIONS:
            name, short, full = f"CC-{code}-{version}", f"cc {code.replace('-', ' ')} {version}".lower(), f"{long.replace('-', ' ')} {version}".lower()
            named += [(name, f"CC {code} {version}", [[short]]), (name, f"a Creative Commons {long} {version} {port} License", [["creative commons " + full]]),
                      (name, f"the Creative Commons {long} {version} license", [["creative commons " + full]]),
                      (name, f"a Creative Commons {code} {version} license", [[f"creative commons {short[3:]}"]])]
            if version == "4.0":
                out.append(Template(name, CC_TEXT.format(name=long, version=version), [["creative commons " + full]]))
    out += [Template(name, s.format(phrase), must) for name, phrase, must in named for s in STATEMENTS]
    for name in sorted({t.license for t in out}):
        own = name.lower().replace("-", " ")
        out.append(Template(name, f"SPDX-License-Identifier: {name}", [[f"spdx license identifier {own}"]]))
    return out
