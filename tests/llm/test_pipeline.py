import random
import re
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from actionlens.llm import quality_rules
from actionlens.llm.queries import QUERIES, piece_model
from actionlens.llm.sql import SQL
from parity import check
from parity.queries import QUERIES as OTHERS
from parity.sql import SQL as OTHER_SQL

from . import test_near_dedup, test_quality_rules

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, name, monkeypatch):
    monkeypatch.setitem(OTHERS, name, QUERIES[name])
    monkeypatch.setitem(OTHER_SQL, name, SQL[name])
    assert check.mismatch(spark, check.open_tables(SF), SF, name) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != "piece encoding":
            assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), after.schema)
        counts.append(docs.count())
    assert 0 < counts[1] < counts[0] and counts[2] == counts[1] and counts[3] <= counts[2] and counts[5] == counts[4]
    assert corpus_pipeline.run(spark, SF).count() == counts[5]
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd, SF).count()
        stage(spark, odd.where("false"), SF).count()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def without_shared_lines(rows):
    """Texts by id without the lines that three documents hold, but for the one with the largest id."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for i, text in rows.items():
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    stays = lambda i, line: len(key(line)) < 20 or len(holders[key(line)]) < 3 or i == max(holders[key(line)])
    return {i: "\n".join(line for line in (text or "").split("\n") if stays(i, line)) for i, text in rows.items()}


def targets(sizes):
    """Words that the mix takes of each source."""
    total, left = sum(sizes.values()), set(sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    out = {}
    while left:
        rest = total - sum(out.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s]}
        if not over:
            return out | share
        out |= {s: 3 * sizes[s] for s in over}
        left -= over
    return out


def test_each_stage_like_brute_force(spark):
    r = random.Random(11)
    vocabulary = [a + b for a in ("ri", "wa", "kin", "tre", "ho", "mo", "sta") for b in ("ver", "ter", "ged", "ing", "use", "on", "al")]
    line = lambda: " ".join(r.choice(vocabulary + ["the", "of", "and", "to"] * 8) for _ in range(12)) + "."
    shared, texts = line(), []
    for i in range(60):
        texts.append("\n".join([line(), line(), *([shared] if i % 4 == 0 else []), line()]))
    texts += [texts[3], texts[5].replace("the", "THE"), texts[7] + " more", None, "", "too short", "x$$ y%% " * 20, "home | login | " * 20]
    rows = [(i, t, "en", [None, "a", "b", "c"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    taken = lambda name, df: spark.createDataFrame((after := stages[name](spark, df, SF)).collect(), after.schema)

    good = taken("quality rules", docs)
    counted = quality_rules.with_counts(docs, ["doc_id"])
    passed = quality_rules.with_votes(counted.where(~quality_rules._failed())).collect()
    patterns = [{rule: x[rule] for rule in quality_rules.votes()} for x in passed]
    shares, rates = test_quality_rules.em_by_hand(patterns, 200)
    want = []
    for x, votes in zip(passed, patterns):
        evidence = {k: shares[k] for k in shares}
        for k in shares:
            for rule, vote in votes.items():
                evidence[k] *= {0: 1, 1: 1 - rates[k][rule], -1: rates[k][rule]}[vote]
        if evidence["good"] >= 0.5 * sum(evidence.values()):
            want.append(x["c0"])
    assert sorted(x["doc_id"] for x in good.collect()) == sorted(want) and 50 < len(want) < len(texts)

    lined = taken("line dedup", good)
    assert {x["doc_id"]: x["text"] for x in lined.collect()} == without_shared_lines({x["doc_id"]: x["text"] for x in good.collect()})
    assert all(x["n_chars"] == len(x["text"]) for x in lined.collect())

    single = taken("near-duplicates", lined)
    kept = [i for i, _, _, stays in test_near_dedup.brute([(x["doc_id"], x["text"]) for x in lined.collect()]) if stays]
    assert sorted(x["doc_id"] for x in single.collect()) == sorted(kept) and len(kept) < len(want)

    mixed = taken("source mix", single)
    size = {x["doc_id"]: len(words_of(x["text"])) for x in single.collect()}
    of_source = Counter()
    for x in single.collect():
        of_source[x["source"]] += size[x["doc_id"]]
    words, by_doc = Counter(), Counter()
    for x in mixed.collect():
        words[x["source"]] += len(words_of(x["text"]))
        by_doc[x["doc_id"]] += len(words_of(x["text"]))
    for source, target in targets(of_source).items():
        # Whole documents are written out, so a source can go over its target by its last document.
        assert abs(words[source] - target) <= max(n for i, n in size.items())
    assert all(n <= 3 * size[i] for i, n in by_doc.items())

    coded = stages["piece encoding"](spark, mixed, SF).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    texts_in = Counter((x["doc_id"], tuple(library.encode(x["text"]))) for x in mixed.collect())
    assert Counter((x["doc_id"], tuple(x["token_ids"])) for x in coded) == texts_in
    assert all(x["text"] == library.decode(x["token_ids"]) and x["n_tokens"] == len(x["token_ids"]) for x in coded)
