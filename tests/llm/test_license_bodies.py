"""License bodies word by word, and the variants of notices."""

from pathlib import Path

import pytest

from urlsift.llm import licenses

AUTOMATA = licenses.compiled()
COMMON = Path("/usr/share/common-licenses/BSD")

BSD_OPEN = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met:\n"
)
CLAUSES = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
    "the documentation and/or other materials provided with the distribution.\n",
    "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product "
    "includes software developed by the University of Somewhere and its contributors.\n",
    "4. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission.\n",
)
BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
MIT_OPEN = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the '
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
MIT_IF = (
    ", subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.\n\n"
)
MIT_END = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
ISC_OPEN = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_IF = ", provided that the above copyright notice and this permission notice appear in all copies.\n\n"
ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, "
    "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
    "any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
    "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of "
    "our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights "
    "to this software under copyright law.\n\n" + MIT_END.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS")
)
BODIES = {
    "bsd-2-clause": BSD_OPEN + "".join(CLAUSES[:2]) + BSD_END,
    "bsd-3-clause": BSD_OPEN + "".join([*CLAUSES[:2], CLAUSES[3].replace("4. ", "* ")]) + BSD_END,
    "bsd-4-clause": BSD_OPEN + "".join(CLAUSES) + BSD_END,
    "mit": MIT_OPEN + MIT_IF + MIT_END,
    "mit-0": MIT_OPEN + ". " + MIT_END,
    "isc": ISC_OPEN + ISC_IF + ISC_END,
    "0bsd": ISC_OPEN + ". " + ISC_END,
    "unlicense": UNLICENSE,
}


def labels(text):
    return {x[0] for x in licenses.scan(text, *AUTOMATA).notices}


@pytest.mark.parametrize("label", BODIES)
def test_whole_bodies(label):
    found = labels(f"Some program.\n\n{BODIES[label]}\nThe end.")
    assert {x for x in found if not x.endswith("-opening")} == {label}


@pytest.mark.parametrize("label", BODIES)
def test_an_altered_body_keeps_the_label_of_its_opening_alone(label):
    words = BODIES[label].split()
    for k in range(30, len(words), 17):
        more = " ".join([*words[:k], "except for any commercial use by persons or firms that sell more than a hundred copies of it", *words[k:]])
        less = " ".join(words[:k] + words[k + 4 :])
        for text in (more, less):
            found = labels(text)
            assert label not in found and any(x.endswith("-opening") for x in found), (k, text[:9])


def test_license_files_of_this_machine():
    if not COMMON.exists():
        pytest.skip("no such file")
    assert "bsd-3-clause" in labels(COMMON.read_text())


FREE = "This program is free software; you can redistribute it and/or modify it under the terms of "


@pytest.mark.parametrize(
    "text, label",
    [
        (FREE + "the GNU General Public License version 2 as published by the Free Software Foundation.", "gpl-2.0-notice"),
        (FREE + "version 2 of the GNU General Public License as published by the Free Software Foundation.", "gpl-2.0-notice"),
        (FREE + "the GNU General Public License as published by the Free Software Foundation, version 3.", "gpl-3.0-notice"),
        (FREE + "the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or "
         "(at your option) any later version.", "agpl-notice"),
        (FREE + "the GNU Affero General Public License version 3 as published by the Free Software Foundation.", "agpl-3.0-notice"),
        (FREE + "the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
         "(at your option) any later version.", "gpl-notice"),
        ("Licensed under the GNU Affero General Public License, version 3", "agpl-3.0"),
        ("Licensed under CC BY-NC-SA 4.0", "cc-by-nc-sa"),
        ("licensed under a CC BY-ND 4.0", "cc-by-nd"),
        ("Licensed under CC BY-NC-ND 3.0.", "cc-by-nc-nd"),
        ("Apache License\nVersion 2.0, January 2004", "apache-2.0-heading"),
    ],
)
def test_variants_of_notices(text, label):
    assert labels(text) == {label}
