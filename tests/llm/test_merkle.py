import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from actionlens.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(digests, fanout):
    """Root, and for each leaf the digests left and right of its way up."""
    paths, level = [[] for _ in digests], [(d, [i]) for i, d in enumerate(digests)]
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for run in runs:
            for k, (_, members) in enumerate(run):
                for m in members:
                    paths[m].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1 :])))
        level = [(sha("".join(d for d, _ in run)), [m for _, ms in run for m in ms]) for run in runs]
    return level[0][0], paths


def brute_force(rows, fanout=2):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3])
        trees[lang] = tree([x[2] for x in by_lang[lang]], fanout)
    root, upper = tree([trees[x][0] for x in langs], fanout) if langs else (None, [])
    out = []
    for lang, above in zip(langs, upper):
        for (_, _, digest, r), path in zip(by_lang[lang], trees[lang][1]):
            folded, doc_id, n = digest, r["doc_id"], r["n_chars"]
            if doc_id is not None and n is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
                folded = leaf(doc_id, r["source"], lang, n + 1, r["text"])
            for before, after in path + above:
                folded = sha(before + folded + after)
            out.append((doc_id, digest, trees[lang][0], root, sha("".join(b + a for b, a in path + above)), folded, folded == root))
    return sorted(out, key=repr)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("fanout", [2, 3, 17])
def test_like_brute_force(spark, fanout):
    langs = [None, "", "en", "é", "zh"]
    # One language holds most rows, so that its tree has several strides of levels; one has a single row.
    frame = spark.range(0, 1200, 1, 5).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("sé"), F.col("id") % 4)).alias("source"),
        F.element_at(F.array(*map(F.lit, langs)), F.when(F.col("id") == 7, 5).when(F.col("id") % 10 == 1, 1 + (F.col("id") % 4).cast("int")).otherwise(3)).alias("lang"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 3).alias("n_chars"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("text\n☃"), F.col("id") % 100)).alias("text"),
    )
    assert got(merkle.verified_manifest(frame, fanout)) == brute_force(frame.collect(), fanout)


def test_odd_rows(odd, no_documents):
    want = brute_force(odd.select("doc_id", "text", "lang", "source", "n_chars").collect())
    assert got(merkle.verified_manifest(odd)) == want
    empty = merkle.verified_manifest(no_documents)
    assert empty.count() == 0 and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_one_row_and_copies(documents):
    alone = merkle.verified_manifest(documents([(7, "only")])).first()
    assert alone["leaf"] == alone["subroot"] == alone["root"] and alone["proof_sha256"] == sha("")
    copies = documents([(3, "same")] * 700, ["s"] * 700)
    assert got(merkle.verified_manifest(copies)) == brute_force(copies.select("doc_id", "text", "lang", "source", "n_chars").collect())


def test_any_change_shows(documents):
    leaves = merkle.document_leaves(documents([(i, f"text {i}") for i in range(50)])).withColumn("root", F.lit("clashing"))
    proven = merkle.proofs(leaves, "lang", ["doc_id"])
    forged = merkle.fold(F.sha2(F.concat("leaf", F.lit("x")), 256), F.col("path"))
    assert proven.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert proven.where(forged == F.col("root")).count() == 0
    with pytest.raises(ValueError):
        merkle.proofs(leaves, "lang", ["doc_id"], fanout=1)
