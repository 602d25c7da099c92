import random
import re
import zlib
from hashlib import sha256

import pytest

from orderloom.llm import manifest

from .support import DOCS, clashing, documents

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    shown = [None if row[c] is None else str(row[c]) for c in manifest.LEAF_COLUMNS]
    return digest("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in shown))


def tower(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        run = i - i % 8
        yield "".join(level[run:i]), "".join(level[i + 1 : run + 8])
        i //= 8


def brute(rows):
    """What the contract says, from sorted lists."""
    trees = {}
    for row in rows:
        trees.setdefault(row["lang"], []).append(row)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        built[lang] = tower([leaf(r) for r in trees[lang]])
    roof = tower([built[lang][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for i, row in enumerate(trees[lang]):
            path = [*siblings(built[lang], i), *siblings(roof, k)]
            text = row["text"]
            if text is not None and row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            node = leaf({**row, "text": text})
            for a, b in path:
                node = digest(a + node + b)
            proof = digest("".join(a + b for a, b in path))
            root = roof[-1][0]
            out.append((row["doc_id"], lang, leaf(row), built[lang][-1][0], root, proof, node, node == root))
    return out


def key(row):
    return str(tuple(row))


def some(n, ids, langs, seed=1):
    rng = random.Random(seed)
    texts = ["Ab", "x", None, "", "É" * 3, "Q" * 5000]
    return [(rng.choice(ids), rng.choice(texts), rng.choice(langs), rng.choice(["s", None]), rng.choice([3, None])) for _ in range(n)]


CASES = {
    "nulls, repeated rows and ids, negative ids": some(400, [None, 1, 2, 3, -5, 2**62], ["en", None, "", "é"]),
    "one row": [(7, "A", "en", "s", 1)],
    "one run and one more": some(9, range(100), ["en"]),
    "several chunks and slot arrays": some(12_000, range(-90_000, 90_000), ["en", "de"]),
    "sparse ids": some(500, [random.Random(i).randrange(-(2**63), 2**63) for i in range(500)], ["é", "z", None]),
    "one row as a third and more": [(None, "A", "en", "s", 1)] * 5000 + some(40, range(9), ["en"]),
}


@pytest.mark.parametrize("case", CASES)
def test_against_sorted_lists(spark, case):
    rows = CASES[case]
    got = manifest.prove(clashing(documents(spark, rows, DOCS)), manifest.lower_some()).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute([dict(zip(COLUMNS, r)) for r in rows]), key=key)


def test_empty_table_and_no_tampering(spark):
    assert manifest.prove(documents(spark, [], DOCS)).count() == 0
    assert all(r["verified"] for r in manifest.prove(documents(spark, some(50, range(30), ["en", "fr"]), DOCS)).collect())


def test_slot_arrays_reduce_as_the_whole_tree():
    nodes = [digest(str(i)) for i in range(manifest.SPAN + 700)]
    whole = tower(nodes)
    parts = [nodes[: manifest.SPAN], nodes[manifest.SPAN :]]
    levels = manifest.levels_above(len(nodes))
    assert [manifest.reduced(p, levels)[-1][0] for p in parts] == whole[levels]
    assert manifest.paths(parts[1], levels)[699] == list(siblings(whole, manifest.SPAN + 699))[:levels]
    assert [manifest.levels_above(n) for n in (0, 1, 2, 8, 9, 64, 65)] == [0, 0, 1, 1, 2, 2, 3]
