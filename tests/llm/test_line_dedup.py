import hashlib
import random

from actionlens.llm import line_dedup


def brute(rows):
    keyed = [(i, [(x, x.strip(" \t\n\x0b\x0c\r").encode().lower().decode()) for x in (t or "").split("\n")]) for i, t in rows]
    holders = {}
    for i, lines in keyed:
        for _, k in lines:
            if len(k) >= 20:
                holders.setdefault(k, set()).add(i)
    low = lambda i: -1 if i is None else i
    out = []
    for i, lines in keyed:
        kept = [x for x, k in lines if len(holders.get(k, ())) < 3 or low(i) == max(map(low, holders[k]))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def digests(df):
    return sorted((tuple(r) for r in line_dedup.line_digests(df, line_dedup.keep_bitmaps(df)).collect()), key=repr)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_against_brute_force(documents):
    r = random.Random(1)
    lines = [f"shared line number {i} éé with some length" for i in range(30)] + ["short", "", "x" * 19, "é" * 20]
    df = documents(["\n".join(r.choice(lines) if r.random() < 0.7 else f"own line {r.random()} of this one" for _ in range(r.randint(0, 12))) for _ in range(200)])
    assert digests(df) == brute(rows_of(df))


def test_common_line_over_partitions(documents, spark):
    spark.conf.set("spark.sql.shuffle.partitions", 7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = documents(["one line that all the documents have in common\nrest %d of the text, long" % (i // 2) for i in range(500)])
        assert digests(df) == brute(rows_of(df))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows(odd, no_documents):
    assert digests(odd) == brute(rows_of(odd))
    assert digests(no_documents) == []


def test_apply_keeps_columns_and_nulls(odd):
    applied = line_dedup.apply_bitmaps(odd, line_dedup.keep_bitmaps(odd))
    assert applied.columns == odd.columns and applied.count() == odd.count()
    assert applied.where("text IS NULL").count() == 2 and applied.where("text_hash = -1").count() == odd.count()
    assert {r["text"] for r in applied.where("doc_id = 4").collect()} == {"own"}
