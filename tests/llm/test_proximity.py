"""Proximity matches against brute force at the defaults."""

import math
import random

import brute
import pytest
from catalog.check import compare, connect

from urlsift.llm import decontaminate, queries

LETTERS = [f"w{k}" for k in range(40)]


def places(docs, items, window=13, play=2, share=0.8):
    """{(id, item, first, start, near)} for docs [(id, text)] and items [(id, text)]."""
    out = set()
    for i, text in docs:
        where = {}
        for p, w in enumerate(brute.words(text)):
            where.setdefault(w, set()).add(p)
        for item, phrase in items:
            t = brute.words(phrase)
            size = min(window, len(t))
            for start in range(-len(t) - play, len(brute.words(text)) + play) if t else ():
                near = [any(start + k + d in where.get(w, ()) for d in range(-play, play + 1)) for k, w in enumerate(t)]
                for first in range(len(t) - size + 1):
                    n = sum(near[first : first + size])
                    if n >= max(1, math.ceil(size * share)):
                        out.add((i, item, first, start, n))
    return out


def found(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    terms = decontaminate.item_terms(spark.createDataFrame(items, "item_id long, text string"))
    index = decontaminate.build_index(decontaminate._documents(d, "doc_id", "text"), terms.select("word", "term").distinct())
    rows = decontaminate.proximity_matches(index, terms, **options).collect()
    got = [(r.id, r.item_id, r["first"], r.start, r.near) for r in rows]
    assert len(got) == len(set(got))
    return set(got)


def edited(rng, words):
    """The words with some replaced, dropped, inserted or swapped."""
    words = list(words)
    for _ in range(rng.randint(0, 4)):
        k = rng.randrange(len(words) - 1)
        kind = rng.randrange(4)
        if kind == 0:
            words[k] = rng.choice([*LETTERS, "unheard"])
        elif kind == 1:
            del words[k]
        elif kind == 2:
            words.insert(k, "unheard")
        else:
            words[k], words[k + 1] = words[k + 1], words[k]
    return words


@pytest.mark.parametrize("options", [{}, {"window": 5, "share": 0.6}, {"window": 4, "play": 0, "share": 1.0}, {"window": 6, "play": 1}])
def test_proximity_equals_brute_force(spark, options):
    rng = random.Random(7)
    items = [(k, [rng.choice(LETTERS) for _ in range(n)]) for k, n in enumerate((1, 2, 4, 13, 14, 20, 30))]
    items.append((7, [*items[5][1][:9], "nowhere", *items[5][1][10:]]))
    docs = []
    for k in range(60):
        noise = lambda: [rng.choice(LETTERS) for _ in range(rng.randint(0, 25))]
        docs.append((k, " ".join([*noise(), *edited(rng, items[3 + k % 5][1]), *noise()])))
    docs += [(3, docs[3][1]), (60, None), (61, "")]
    items = [(k, " ".join(w)) for k, w in items] + [(8, None)]
    want = places(docs, items, **options)
    assert want and found(spark, docs, items, **options) == want


def test_a_window_without_its_rarest_word_is_near(spark):
    quote = [f"common{k}" for k in range(13)]
    item = " ".join([*quote[:6], "rarest", *quote[7:]])
    docs = [(1, " ".join(["so", *quote[:6], "replaced", *quote[7:], "end"])), (2, "rarest"), *[(k, " ".join(quote[::-1])) for k in range(3, 9)]]
    for shown in (docs, [d for d in docs if d[0] != 2]):
        assert {(i, n) for i, _, _, _, n in found(spark, shown, [(5, item)])} == {(1, 12)}


def test_near_columns_beside_those_of_the_statement(spark, sf, folder):
    near = queries.op3_near(spark, sf)
    both = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert near.columns[: len(both)] == both
    assert compare(near.select(both), connect(sf), queries.OP3_SQL) == ""
    items = [(1, "a b c d e f g h i j k l m n"), (2, "p q r s t")]
    docs = [(1, "a b c d e x g h i j k l m"), (2, items[0][1]), (None, "s t p q r"), (4, None), (5, "p q r x t"), (5, "p q r x t")]
    path = folder(
        documents=spark.createDataFrame(docs, "doc_id long, text string"), benchmark=spark.createDataFrame(items, "item_id long, text string")
    )
    near_ids = [sorted({str(item) for k, item, *_ in places([(j, t) for j, (_, t) in enumerate(docs)], items) if k == j}) for j in range(len(docs))]
    assert near_ids[:2] == [["1"], ["1"]] and near_ids[4] == ["2"]
    got = sorted(((r.doc_id, r.n_items, r.n_near, r.near_sha256) for r in queries.op3_near(spark, path).collect()), key=repr)
    phrases = [len(x[2]) for x in brute.contamination(docs, items)]
    want = [(i, n, len(x), brute.sha(",".join(x))) for (i, _), n, x in zip(docs, phrases, near_ids, strict=True)]
    assert got == sorted(want, key=repr)
