"""Secret scan: known forms, and sliding-window Shannon entropy over candidate strings.

Candidates are long runs of token characters. For each character class a window slides over the candidate's runs
of that class; the counts of its characters are changed by the one that enters and the one that leaves, and with
them the entropy. Windows at or above the class's threshold are joined into spans. The allow-list takes its own pieces out
of a candidate, those between ``/`` and ``=``, and leaves the others to be scanned. Spans inside a known form aren't repeated.
"""

from __future__ import annotations

import re
from math import log2

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed: the known forms, in the order their spans are listed.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs; shorter ones fail
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: name, characters, threshold in bits (a window of 20 can reach 4.32), what a window needs besides
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]{20,}"), 3.0, (re.compile("[0-9]"), re.compile("[a-fA-F]"))),
    ("base36", re.compile(r"[a-z0-9]{20,}"), 3.4, (re.compile("[0-9]"), re.compile("[a-z]"))),
    ("base32", re.compile(r"[A-Z0-9]{20,}"), 3.4, (re.compile("[0-9]"), re.compile("[A-Z]"))),
    ("base64", re.compile(r"[A-Za-z0-9+/]{20,}"), 3.8, (re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]"))),
    ("base64url", re.compile(r"[A-Za-z0-9_-]{20,}"), 3.9, (re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]"))),
)
PIECE = re.compile(r"[^/=]+")
#: Pieces that match one of these in full, or contain one of the marks, are no secrets.
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"),
    re.compile(r"(.)\1*"),
    re.compile(r"[0-9]+"),
)
#: A digest behind its name, whole, in hex or base64; it may hold delimiters.
DIGEST = re.compile(
    r"(?<![A-Za-z0-9+_-])(?:"
    + "|".join(
        rf"{name}[-_=](?:[0-9a-fA-F]{{{2 * n}}}|[A-Za-z0-9+/_-]{{{-(-4 * n // 3)}}}{'=' * (-n % 3)})"
        for name, n in (("md5", 16), ("sha1", 20), ("sha256", 32), ("sha384", 48), ("sha512", 64))
    )
    + r")(?![A-Za-z0-9+_-])"
)
ALLOWED_MARKS = ("example", "sample", "dummy", "placeholder", "abcdefghij", "0123456789", "xxxxxx")
_TERM = [0.0, *(n * log2(n) for n in range(1, WINDOW + 1))]


def window_spans(run: str, threshold: float, needs=(), window: int = WINDOW) -> list[tuple[int, int]]:
    """Joined spans of the windows of ``run`` whose entropy is at least ``threshold`` and which hold what is needed."""
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    term = _TERM if window == WINDOW else [0.0, *(n * log2(n) for n in range(1, window + 1))]
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += term[n + 1] - term[n]
        if i >= window:
            out = run[i - window]
            n = counts[out]
            counts[out] = n - 1
            total += term[n - 1] - term[n]
        if i >= window - 1 and log2(window) - total / window >= threshold - 1e-9:
            a = i - window + 1
            if all(x.search(run, a, i + 1) for x in needs):
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((a, i + 1))
    return spans


def allowed(piece: str) -> bool:
    low = piece.lower()
    return any(x.fullmatch(piece) for x in ALLOWED) or any(m in low for m in ALLOWED_MARKS)


def open_parts(candidate: str) -> list[tuple[int, int]]:
    """The stretches of a candidate between its allowed pieces."""
    taken = [m.span() for m in DIGEST.finditer(candidate)] + [m.span() for m in PIECE.finditer(candidate) if allowed(m.group())]
    parts, at = [], 0
    for a, b in sorted(taken):
        if a - at >= WINDOW:
            parts.append((at, a))
        at = max(at, b)
    return [*parts, (at, len(candidate))]


def known_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the known forms, each kind leftmost and without overlaps; too short matches are dropped."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def entropy_spans(text: str, known: list[tuple[int, int, str]] = ()) -> list[tuple[int, int, str]]:
    """Spans of high entropy in code points that don't lie inside a span of ``known``; those that overlap are one."""
    found = set()
    for m in CANDIDATE.finditer(text):
        candidate = m.group()
        for first, end in open_parts(candidate):
            for _, characters, threshold, needs in CLASSES:
                for run in characters.finditer(candidate, first, end):
                    for a, b in window_spans(run.group(), threshold, needs):
                        found.add((m.start() + run.start() + a, m.start() + run.start() + b))
    spans: list[tuple[int, int, str]] = []
    begun, reach, sorted_known = 0, -1, sorted(known)
    for a, b in sorted(found):
        while begun < len(sorted_known) and sorted_known[begun][0] <= a:
            reach = max(reach, sorted_known[begun][1])
            begun += 1
        if b <= reach:
            continue
        if spans and a < spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]), "entropy")
        else:
            spans.append((a, b, "entropy"))
    return spans


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def secrets(text: Column) -> Column:
    """Column of struct<n_assign, n_access, n_hex, base, spans> for each whole text; a null text is empty. ``base`` lists
    the known forms and ``spans`` all as kind:start:end in code points, by start, then kind."""

    @F.arrow_udf("struct<n_assign: long, n_access: long, n_hex: long, base: string, spans: string>")
    def of(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            value = t.as_py() or ""
            known = known_spans(value)
            every = sorted(known + entropy_spans(value, known), key=lambda s: (s[0], KINDS.index(s[2])))
            kinds = [s[2] for s in known]
            rows.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"), listed(known), listed(every)))
        columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.StructArray.from_arrays(arrays, ["n_assign", "n_access", "n_hex", "base", "spans"])

    return of(text)
