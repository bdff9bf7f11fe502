"""Merkle manifests against a plain recursion."""

import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from playmart.llm.manifest import LOWER, UPPER, merkle_manifest
from playmart.operators import Scratch

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, fanout):
    """(root, path of (left, right) for every node)."""
    paths = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        starts = range(0, len(nodes), fanout)
        for s in starts:
            run = nodes[s : s + fanout]
            for k in range(len(run)):
                for i in owners[s + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
        owners = [sum(owners[s : s + fanout], []) for s in starts]
        nodes = [digest(*nodes[s : s + fanout]) for s in starts]
    return nodes[0], paths


def plain(docs, fanout=16):
    def leaf(d, text):
        return digest(*[field(v) for v in (d[0], d[3], d[2], d[4], text)])

    groups = {}
    for d in docs:
        groups.setdefault(d[3], []).append(d)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        rows = sorted(groups[name], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d, d[1])))
        trees[name] = (rows, *climb([leaf(d, d[1]) for d in rows], fanout))
    if not names:
        return Counter()
    root, tops = climb([trees[n][1] for n in names], fanout)
    found = Counter()
    for name, top in zip(names, tops, strict=True):
        rows, subroot, paths = trees[name]
        for d, path in zip(rows, paths, strict=True):
            path = path + top
            text = d[1]
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0 and text is not None:
                text = text.translate(str.maketrans(UPPER, LOWER))
            node = leaf(d, text)
            for left, right in path:
                node = digest(left, node, right)
            proof = digest(*[left + right for left, right in path])
            found[d[0], leaf(d, d[1]), subroot, root, proof, node, node == root] += 1
    return found


def manifest(spark, rows, fanout=16, extra=()):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in extra:
        docs = docs.withColumn(name, F.lit("own"))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = {"text": F.when(hit, F.translate("text", UPPER, LOWER))}
    made = merkle_manifest(docs, Scratch(spark, "manifest"), tampered=tampered, fanout=fanout)
    columns = "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    return Counter(tuple(r) for r in made.select(*columns).collect())


ODD = [
    (1, "Text A", "en", "a", 6),
    (2, None, None, None, None),
    (None, "", "en", "a", 0),
    (None, "Z" * 100_000, "de", "lone", 3),
    (5, "Ünïcode ÄB", "de", "ß", 7),
    (5, "Ünïcode ÄB", "de", "ß", 7),
    (-3, "B", "en", "", 1),
]


@pytest.mark.parametrize("fanout", [2, 16])
def test_odd_rows(spark, fanout):
    rows = ODD + [(i, f"Body {i}", "en", f"s{i % 3}" if i % 2 else "hot", i) for i in range(6, 120)]
    found = manifest(spark, rows, fanout)
    assert found == plain(rows, fanout)
    assert {v[-1] for v in found} == {True, False}


def test_one_group_and_one_row(spark):
    rows = [(i, "Same", "en", "a", 4) for i in (1, 1, 1)] + [(i, "x", "en", "a", 1) for i in range(2, 19)]
    assert manifest(spark, rows) == plain(rows)
    assert manifest(spark, ODD[:1]) == plain(ODD[:1])


def test_an_empty_table_and_clashing_columns(spark):
    assert manifest(spark, []) == Counter()
    taken = ["leaf", "pos", "node", "n", "group_key", "path", "place", "parent", "verified", "c0"]
    assert manifest(spark, ODD, extra=taken) == plain(ODD)
