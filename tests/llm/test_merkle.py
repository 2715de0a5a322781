import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tillroll.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    doc_id, text, lang, source = (tuple(row) + (None,) * 4)[:4]
    return sha("".join(map(field, (doc_id, source, lang, len(text or ""), text))))


def tree(digests, fan):
    rows = [digests]
    while len(rows[-1]) > 1:
        row = rows[-1]
        rows.append([sha("".join(row[at : at + fan])) for at in range(0, len(row), fan)])
    return rows


def path(rows, at, fan):
    found = []
    for row in rows[:-1]:
        first = at // fan * fan
        found.append(("".join(row[first:at]), "".join(row[at + 1 : first + fan])))
        at //= fan
    return found


def brute_force(rows, fan=16):
    """(doc_id, leaf, subroot, root, siblings) of every row, from whole trees."""
    sources = {}
    for row in rows:
        sources.setdefault(row[3] if len(row) > 3 else None, []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, own in sources.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = tree([leaf(r) for r in own], fan)
    top = tree([trees[source][-1][0] for source in order], fan)
    for number, source in enumerate(order):
        for at, row in enumerate(sources[source]):
            siblings = path(trees[source], at, fan) + path(top, number, fan)
            yield row[0], leaf(row), trees[source][-1][0], top[-1][0], siblings


def rows_of(sizes):
    made, number = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            made.append((number * 7 % 100_003, f"Text {number} É", "en", source))
            number += 1
    return made


SIZES = [
    {"a": 1},
    {"a": 16, "b": 17, None: 1},
    {"a": 300, "b": 5, None: 2, "é": 257, "z": 1},
    {f"s{n}": 1 + n % 3 for n in range(40)},
]


@pytest.mark.parametrize(
    "sizes, fan, stride",
    [(SIZES[0], 16, 3), (SIZES[1], 16, 1), (SIZES[2], 16, 3), (SIZES[2], 4, 2), (SIZES[3], 3, 2)],
)
def test_proofs_against_whole_trees(spark, docs, tmp_path, sizes, fan, stride):
    rows = rows_of(sizes)
    merkle.write_manifest(docs(rows), str(tmp_path), fan=fan, stride=stride)
    manifest = merkle.read_manifest(spark, str(tmp_path))
    got = {
        r.doc_id: (r.leaf, r.subroot, manifest.root, list(zip(r.before, r.after)))
        for r in merkle.proofs(spark, manifest).collect()
    }
    assert got == {doc_id: tuple(rest) for doc_id, *rest in brute_force(rows, fan)}


def test_only_every_few_levels_are_kept(spark, docs, tmp_path):
    manifest = merkle.write_manifest(docs(rows_of({"a": 1_000})), str(tmp_path), fan=2, stride=4)
    kept = [manifest.nodes(spark, level).count() for level in range(manifest.levels)]
    assert kept == [1_000, 63, 4, 1]


def test_every_root_is_folded_up_again(docs):
    rows = rows_of({"a": 70, "b": 3, None: 1})
    got = merkle.manifest_digests(docs(rows), merkle.tampered_leaf()).collect()
    expected = {doc_id: rest for doc_id, *rest in brute_force(rows)}
    assert len(got) == len(expected) == len(rows)
    texts = {row[0]: row for row in rows}
    for r in got:
        own, subroot, root, siblings = expected[r.doc_id]
        assert (r.leaf, r.subroot, r.root) == (own, subroot, root)
        assert r.proof_sha256 == sha("".join(a + b for a, b in siblings))
        doc_id, text, *rest = texts[r.doc_id]
        hit = zlib.crc32(str(doc_id).encode()) % 5 == 0
        claimed = leaf((doc_id, text.translate(LOWER) if hit else text, *rest))
        for before, after in siblings:
            claimed = sha(before + claimed + after)
        assert r.folded_root == claimed and r.verified == (claimed == root) == (not hit)


def test_a_foreign_leaf_is_found(docs):
    frame = docs(rows_of({"a": 20, "b": 20}))
    wrong = F.when(F.col("doc_id") == 7, F.sha2(F.lit("x"), 256)).otherwise(merkle.leaf_digest())
    found = merkle.manifest_digests(frame, wrong).where("not verified").collect()
    assert [r.doc_id for r in found] == [7]


def test_nulls_empties_ties_repeats_and_clashing_columns(docs):
    rows = [
        (None, None, None, None),
        (None, "A", None, None),
        (5, "", "en", "s"),
        (5, "A", "en", "s"),
        (5, "A", "en", "s"),
        (6, "W " * 200_000, None, "s"),
        *[(8, "same", "en", "hot")] * 600,
    ]
    frame = docs(rows, ("tree", "place", "total", "digest", "claimed", "tie", "at", "block"))
    got = merkle.manifest_digests(frame).collect()
    assert all(r.verified for r in got)
    expected = [
        (doc_id, own, subroot, root, sha("".join(a + b for a, b in siblings)))
        for doc_id, own, subroot, root, siblings in brute_force(rows)
    ]
    key = lambda row: tuple(map(str, row))
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(expected, key=key)


def test_empty_table(spark, docs, tmp_path):
    assert merkle.manifest_digests(docs([])).collect() == []
    manifest = merkle.write_manifest(docs([]), str(tmp_path))
    assert manifest.root is None and merkle.proofs(spark, manifest).collect() == []
