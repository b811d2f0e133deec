"""License scan by template markup.

A template is the wording of a notice with regions in markup: what stands between ``<<beginOptional>>`` and
``<<endOptional>>`` may be missing, ``<<var;name;pattern;least-most>>`` stands for a number of words that each match
the pattern. Templates are compiled into one token automaton; a notice is accepted where all mandatory wording
matches word by word. The bodies of MIT, BSD, ISC and the Unlicense are there as a whole; a label that ends in ``-opening``
or ``-heading`` stands for that excerpt alone and says nothing about what follows it. Plain phrases are found beside
the templates.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from urlsift.llm.common import word_blocks

#: Fixed: phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

_ANY = "<<var;{};.*;{}>>"
_HOLDER = _ANY.format("holder", "1-12")
_BULLET = "<<var;bullet;[0-9][0-9]?|[a-d]|ii?i?|iv;0-1>>"
_AS_IS = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
    "of merchantability fitness for a particular purpose and <<var;non;non;0-1>> <<var;infringement;(non)?infringement;1-1>> in no "
    "event shall {} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising "
    "from out of or in connection with the software or the use or other dealings in the software"
)
_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
    "<<beginOptional>>the software<<endOptional>> to deal in the software without restriction including without limitation the rights "
    "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the "
    "software is furnished to do so {}" + _AS_IS.format(_HOLDER)
)
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    f"conditions are met {_BULLET} redistributions of source code must retain the above copyright notice this list of conditions "
    f"and the following disclaimer {_BULLET} redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials provided with the distribution {} "
    f"this software is provided by {_HOLDER} as is and any express or implied warranties including but not limited to the implied "
    f"warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {_HOLDER} be liable for "
    "any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of "
    "substitute goods or services loss of use data or profits or business interruption however caused and on any theory of "
    "liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use "
    "of this software even if advised of the possibility of such damage"
)
_ADVERTISING = (
    f"{_BULLET} all advertising materials mentioning features or use of this software must display the following "
    f"acknowledgement this product includes software developed by {_HOLDER} "
)
_ENDORSEMENT = (
    f"{_BULLET} neither the <<var;name;names?;1-1>> of {_HOLDER} nor the names of <<var;whose;.*;0-1>> contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission"
)
_ENDORSEMENT_NAME = (
    f"{_BULLET} the name of {_HOLDER} may not be used to endorse or promote products derived from this software without specific "
    "prior written permission"
)
_ISC = (
    "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with or without fee "
    f"is hereby granted {{}} the software is provided as is and {_HOLDER} <<var;disclaims;disclaims?;1-1>> all warranties with "
    "regard to this software including all implied warranties of merchantability and fitness in no event shall "
    f"{_HOLDER} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss "
    "of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection "
    "with the use or performance of this software"
)
_FREE = "is free software you can redistribute it and or modify it under the terms of "
_FSF = " as published by the free software foundation"
_LATER = (
    _FSF + " either version <<var;version;[0-9]+;1-2>> of the license or <<beginOptional>>at your option<<endOptional>> any later version"
)


def _named(name: str, version: str) -> tuple[str, ...]:
    """Notices that name one version, as the version-only form does; what follows them isn't compared."""
    return (
        f"{_FREE} the {name} <<beginOptional>>v<<endOptional>> <<beginOptional>>version<<endOptional>> {version} "
        f"<<beginOptional>>only<<endOptional>> {_FSF}",
        f"{_FREE} version {version} <<beginOptional>>only<<endOptional>> of the {name} {_FSF}",
        f"{_FREE} the {name} {_FSF} <<beginOptional>>only<<endOptional>> version {version}",
    )


#: label -> templates
_KINDS = ("by", "by-sa", "by-nc", "by-nc-sa", "by-nd", "by-nc-nd")
_VERSION = "<<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>> "
TEMPLATES = {
    "apache-2.0": (
        "licensed under the apache license <<beginOptional>>version<<endOptional>> 2.0",
    ),
    "apache-2.0-heading": ("apache license version 2.0 january 2004",),
    "mit": (
        "released under the <<beginOptional>>terms of the<<endOptional>> mit license",
        "licensed under the <<beginOptional>>terms of the<<endOptional>> mit license",
        _MIT.format(
            "subject to the following conditions the above copyright notice and this permission notice <<beginOptional>>including the "
            "next paragraph<<endOptional>> shall be included in all copies or substantial portions of the software "
        ),
    ),
    "mit-0": (_MIT.format(""),),
    "mit-opening": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files <<beginOptional>>the software<<endOptional>> to deal in the software without restriction",
    ),
    "gpl-2.0": (
        "licensed under the gnu general public license version 2 <<beginOptional>>or any later version<<endOptional>>",
    ),
    "gpl-3.0": (
        "licensed under the gnu general public license version 3 <<beginOptional>>or any later version<<endOptional>>",
    ),
    "gpl-notice": (_FREE + "the gnu general public license" + _LATER,),
    "lgpl-notice": tuple(_FREE + f"the gnu {kind} general public license" + _LATER for kind in ("lesser", "library")),
    **{
        f"lgpl-{version}": tuple(
            f"licensed under the gnu {kind} general public license version {words} <<beginOptional>>or any later version<<endOptional>>"
            for kind in ("lesser", "library"))
        for version, words in (("2.0", "2 <<var;zero;0;0-1>>"), ("2.1", "2 1"), ("3.0", "3 <<var;zero;0;0-1>>"))
    },
    "gpl-2.0-notice": _named("gnu general public license", "2"),
    "gpl-3.0-notice": _named("gnu general public license", "3"),
    "agpl-3.0": (
        "licensed under the gnu affero general public license version 3 <<beginOptional>>or any later version<<endOptional>>",
    ),
    "agpl-notice": (_FREE + "the gnu affero general public license" + _LATER,),
    "agpl-3.0-notice": _named("gnu affero general public license", "3"),
    **{
        f"cc-{kind}-{version}": (f"licensed under <<beginOptional>>a<<endOptional>> cc {kind} {version}",)
        for kind in _KINDS for version in ("1.0", "2.0", "2.5", "3.0", "4.0")
    },
    **{
        f"cc-{kind}": (f"licensed under <<beginOptional>>a<<endOptional>> cc {kind} <<var;version;0|[5-9]|[0-9]{{2,}};1-1>> <<var;version;[0-9]+;1-1>>",)
        for kind in _KINDS
    },
    "cc-by-long": (
        "licensed under <<beginOptional>>a<<endOptional>> creative commons attribution <<var;kind;.*;0-4>> <<var;version;[0-9]+;2-2>> "
        "<<beginOptional>>international<<endOptional>> license",
    ),
    "bsd-2-clause": (_BSD.format(""),),
    "bsd-3-clause": (_BSD.format(_ENDORSEMENT), _BSD.format(_ENDORSEMENT_NAME)),
    "bsd-4-clause": (_BSD.format(_ADVERTISING + _ENDORSEMENT), _BSD.format(_ADVERTISING + _ENDORSEMENT_NAME)),
    "bsd-opening": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met",
    ),
    "isc": (
        _ISC.format("provided that the above copyright notice and this permission notice appear in all copies"),
    ),
    "0bsd": (_ISC.format(""),),
    "isc-opening": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    ),
    **{
        f"mpl-{version}": tuple(f"{head} the mozilla public license {_VERSION}{version}" for head in ("subject to the terms of", "licensed under"))
        for version in ("1.0", "1.1", "2.0")
    },
    "mpl": tuple(f"{head} the mozilla public license" for head in ("subject to the terms of", "licensed under")),
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell "
        "or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial "
        "and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all "
        "copyright interest in the software to the public domain we make this dedication for the benefit of the public at large and "
        "to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity "
        "of all present and future rights to this software under copyright law " + _AS_IS.format("the authors"),
    ),
    "unlicense-opening": ("this is free and unencumbered software released into the public domain",),
    "copyright": (
        "copyright <<beginOptional>>c<<endOptional>> <<var;year;[0-9]{4};1-2>> <<var;holder;.*;0-6>> all rights reserved",
    ),
}

#: Bytes outside words become spaces, A-Z become a-z.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_MARK = re.compile(r"<<(.*?)>>")
_VERSIONED = re.compile(r"-[0-9]+\.[0-9]+$")


def fold(text: str) -> bytes:
    return text.encode().translate(_FOLD)


@dataclass
class Automaton:
    """States with edges by word, edges by pattern, and free edges; ``accepts`` gives the label and the number of mandatory words."""

    by_word: list[dict[bytes, list[int]]] = field(default_factory=list)
    by_pattern: list[list[tuple[re.Pattern, int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    accepts: dict[int, tuple[str, int]] = field(default_factory=dict)
    starts: dict[bytes, list[int]] = field(default_factory=dict)
    longest: int = 0

    def state(self) -> int:
        self.by_word.append({})
        self.by_pattern.append([])
        self.free.append([])
        return len(self.by_word) - 1

    def add(self, label: str, template: str) -> None:
        """The first word of a template has to be mandatory."""
        start = at = self.state()
        opened: list[int] = []
        mandatory = reach = 0
        for k, part in enumerate(_MARK.split(template)):
            if k % 2 == 0:
                for word in fold(part).split():
                    after = self.state()
                    self.by_word[at].setdefault(word, []).append(after)
                    at, mandatory, reach = after, mandatory + (not opened), reach + 1
            elif part == "beginOptional":
                opened.append(at)
            elif part == "endOptional":
                after = self.state()
                self.free[at].append(after)
                self.free[opened.pop()].append(after)
                at = after
            else:
                _, _, pattern, span = part.split(";")
                least, most = map(int, span.split("-"))
                exits, regex = [at] if least == 0 else [], re.compile(pattern.encode())
                for n in range(1, most + 1):
                    after = self.state()
                    self.by_pattern[at].append((regex, after))
                    at = after
                    if n >= least:
                        exits.append(at)
                end = self.state()
                for leaving in exits:
                    self.free[leaving].append(end)
                at, reach = end, reach + most
        self.accepts[at] = (label, mandatory)
        for word in self.by_word[start]:
            self.starts.setdefault(word, []).append(start)
        self.longest = max(self.longest, reach)

    def _closed(self, states: set[int]) -> set[int]:
        queue = list(states)
        while queue:
            for s in self.free[queue.pop()]:
                if s not in states:
                    states.add(s)
                    queue.append(s)
        return states

    def match(self, words: list[bytes], at: int) -> list[tuple[str, int, int]]:
        """(label, mandatory words, end) of the longest acceptance of each label from word ``at`` on, and of labels
        that differ in their version alone the longest: a text that names version 2.1 doesn't name version 2."""
        now, best = self._closed(set(self.starts.get(words[at], ()))), {}
        for i in range(at, len(words)):
            word, after = words[i], set()
            for s in now:
                after.update(self.by_word[s].get(word, ()))
                after.update(t for regex, t in self.by_pattern[s] if regex.fullmatch(word))
            if not after:
                break
            now = self._closed(after)
            for s in now:
                if s in self.accepts:
                    label, mandatory = self.accepts[s]
                    best[label] = (label, mandatory, i + 1)
        longest: dict[str, int] = {}
        for label, _, end in best.values():
            family = _VERSIONED.sub("", label)
            longest[family] = max(longest.get(family, 0), end)
        return [x for x in best.values() if x[2] == longest[_VERSIONED.sub("", x[0])]]


def compiled(templates: dict[str, tuple[str, ...]] = TEMPLATES, phrases=PHRASES) -> tuple[Automaton, Automaton]:
    """The automaton of the templates and that of the plain phrases."""
    notices, plain = Automaton(), Automaton()
    for label, texts in templates.items():
        for text in texts:
            notices.add(label, text)
    for text, label in phrases:
        plain.add(label, text)
    return notices, plain


@dataclass
class Scan:
    n_words: int = 0
    phrases: list[tuple[str, int, int]] = field(default_factory=list)
    notices: list[tuple[str, int, int]] = field(default_factory=list)
    score: float = 0.0


def scan(text: str | None, notices: Automaton, plain: Automaton) -> Scan:
    """Phrases and notices of a whole text as (label, first word, end). A null or empty text has none. The score is 0 without
    any, 1/2 for phrases alone and nears 1 with the mandatory words of the longest notice."""
    found, first = Scan(), {*notices.starts, *plain.starts}
    ahead = max(notices.longest, plain.longest)
    held: list[bytes] = []

    def take(words: list[bytes], stop: int) -> None:
        for i in [i for i, w in enumerate(words[:stop]) if w in first]:
            for label, _, end in plain.match(words, i):
                found.phrases.append((label, found.n_words + i, found.n_words + end))
                found.score = max(found.score, 0.5)
            for label, mandatory, end in notices.match(words, i):
                found.notices.append((label, found.n_words + i, found.n_words + end))
                found.score = max(found.score, 1 - 1 / (1 + mandatory))
        found.n_words += stop

    for words in word_blocks(fold(text or "")):
        held += words
        if len(held) > ahead:
            stop = len(held) - ahead
            take(held, stop)
            held = held[stop:]
    take(held, len(held))
    return found


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))


def licenses(text: Column, templates: dict[str, tuple[str, ...]] = TEMPLATES, phrases=PHRASES) -> Column:
    """Column of struct<n_words, phrases, notices, score>: spans are (label, first word, end) of the folded words."""

    @F.arrow_udf(
        "struct<n_words: long, phrases: array<struct<label: string, first: long, end: long>>, "
        "notices: array<struct<label: string, first: long, end: long>>, score: double>"
    )
    def of(texts: pa.Array) -> pa.Array:
        both = compiled(templates, phrases)
        found = [scan(t.as_py(), *both) for t in texts]
        spans = [
            pa.array([[dict(zip(("label", "first", "end"), x, strict=True)) for x in getattr(f, part)] for f in found], _SPANS)
            for part in ("phrases", "notices")
        ]
        columns = [pa.array([f.n_words for f in found], pa.int64()), *spans, pa.array([f.score for f in found], pa.float64())]
        return pa.StructArray.from_arrays(columns, ["n_words", "phrases", "notices", "score"])

    return of(text)
