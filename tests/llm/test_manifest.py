"""The manifest against a plain recursive Merkle tree."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from webloom.llm import manifest as M
from webloom.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    shown = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in shown))


def climb(leaves):
    """Root and, per leaf, its siblings level by level as (place, others)."""
    level, groups, paths = list(leaves), [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(level) > 1:
        new, new_groups = [], []
        for k in range(0, len(level), 3):
            run = level[k : k + 3]
            for at, members in enumerate(groups[k : k + 3]):
                for m in members:
                    paths[m].append((at, run[:at] + run[at + 1 :]))
            new.append(sha("".join(run)))
            new_groups.append([m for g in groups[k : k + 3] for m in g])
        level, groups = new, new_groups
    return level[0], paths


def brute(rows):
    per_source = defaultdict(list)
    for r in rows:
        per_source[r["source"]].append((r["doc_id"] is not None, r["doc_id"], leaf_of(r, r["text"]), r))
    names = sorted(per_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        own = sorted(per_source[s], key=lambda x: (x[0], x[1] or 0, x[2]))
        trees.append((own, *climb([x[2] for x in own])))
    root, above = climb([t[1] for t in trees])
    out = Counter()
    for (own, subroot, paths), upper in zip(trees, above, strict=True):
        for (_, doc_id, leaf, r), path in zip(own, paths, strict=True):
            text = r["text"]
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = leaf_of(r, text)
            for at, others in path + upper:
                node = sha("".join([*others[:at], node, *others[at:]]))
            proof = sha("".join(d for _, others in path + upper for d in others))
            out[doc_id, leaf, subroot, root, proof, node, node == root] += 1
    return out


def rows_of(df):
    return [r.asDict() for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize("height", [2, M.HEIGHT])
def test_messy_rows(spark, messy, height):
    got = Counter(map(tuple, M.document_manifest(messy, height).collect()))
    assert got == brute(rows_of(messy))


@pytest.mark.parametrize("height", [2, M.HEIGHT])
def test_tables_of_many_levels(spark, height):
    r = random.Random(height)
    rows = [(k * 3 - 50, f"t{k}" + "\n" * (k % 4), "en", None if k % 11 == 0 else "hot" if k % 3 else f"s{k % 7}é", k)
            for k in range(900)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = Counter(map(tuple, M.document_manifest(df, height).collect()))
    want = brute(rows_of(df))
    assert got == want
    assert any(not k[-1] for k in want) and any(k[-1] for k in want)


def test_large_ids_beside_null_ids_stay_exact(spark):
    big = 2**62 + 1
    df = spark.createDataFrame([(big, "a", "en", "s", 1), (None, "b", "en", "s", 1)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    assert Counter(map(tuple, M.document_manifest(df).collect())) == brute(rows_of(df))


def test_query(spark, small):
    got = QUERIES["op13_manifest"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == brute(rows_of(small))


def test_empty_table(spark, nothing):
    assert M.document_manifest(nothing).count() == 0


@pytest.mark.parametrize("height", range(8))
def test_layout_is_a_permutation_that_keeps_subtrees_together(height):
    found = M.places(height)
    every = np.sort(np.concatenate(found))
    assert np.array_equal(every, np.arange((3 ** (height + 1) - 1) // 2))
    if height:
        upper, lower = (height - 1) // 2, height - (height - 1) // 2 - 1
        size = (3 ** (lower + 1) - 1) // 2
        for k in range(3 ** (upper + 1)):  # each lower tree is one run of places
            own = np.concatenate([found[upper + 1 + d][k * 3**d : (k + 1) * 3**d] for d in range(lower + 1)])
            assert own.max() - own.min() == size - 1 and len(own) == size


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10, 27, 28, 80, 81])
def test_siblings_fold_to_the_root(n):
    leaves = [hashlib.sha256(bytes([k])).digest() for k in range(n)]
    height = M.height_of(n, 9)
    layout = M.build(leaves, height)
    root, paths = climb([d.hex() for d in leaves])
    for k in range(n):
        path = M.siblings(layout, height, n, k)
        assert [(at, [d.hex() for d in o]) for at, o in path] == paths[k]
        assert M.folded(leaves[k], path).hex() == root and M.unpacked(M.packed(path)) == path


def test_written_manifest_holds_every_level(spark, small, tmp_path):
    leaf = M.leaf_digest(*[small[c] for c in ("doc_id", "source", "lang", "n_chars", "text")])
    made = M.build_manifest(small, leaf, height=2)
    M.write_manifest(made, str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m"))
    assert back.where("tree = 0 and level = 0").selectExpr("sum(n)").first()[0] == small.count()
    assert set(r.level for r in back.where("tree = 0").select("level").distinct().collect()) == set(range(len(made.levels)))
