import math
import random
from collections import Counter

import numpy as np

from actionlens.llm import byte_network, language


def test_network_learns_marks(documents, spark):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    texts = [" ".join(word() + ("!!" if i % 3 == 0 else "") for _ in range(r.randint(20, 300))) for i in range(300)]
    df = documents(texts)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(300)] + [(None, 1), (9999, 0), (5, None)], "doc_id long, quality int")
    rows = byte_network.held_out_quality(df, labels).collect()
    held = [x for x in rows if x["held_out"]]
    assert len(held) > 60 and np.mean([x["predicted"] == (x["doc_id"] % 3 != 0) for x in held]) > 0.95


def test_the_whole_text_counts():
    network = byte_network.ByteNetwork()
    text = b"plain words " * 5000
    ends = lambda t: np.array([0, len(t)])
    score = lambda t: network.probabilities(np.frombuffer(t, np.uint8), ends(t))[0]
    assert score(text) != score(text + b"#%!") != score(b"#%!" + text)
    one, two = b"a" * 700, b"b" * 3
    both = network.probabilities(np.frombuffer(one + two, np.uint8), np.array([0, 700, 703]))
    assert np.allclose(both, [score(one), score(two)])


def test_gradient():
    network = byte_network.ByteNetwork()
    network.offset += 0.05  # off the kink of outputs that are exactly zero
    random_bytes = np.random.default_rng(1)
    texts = [random_bytes.integers(32, 126, n).astype(np.uint8).tobytes() for n in (320, 1400, 1)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    labels = np.array([1, 0, 1], np.float32)
    loss = lambda: -np.mean(np.log(np.where(labels == 1, p := network.probabilities(data, offsets), 1 - p)))
    gradients = network._gradients(data, offsets, labels)
    for x, g in zip((network.filters, network.offset, network.weights, network.bias), gradients):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = x[at], np.float32(1e-3)
        x[at] = old + step
        up = loss()
        x[at] = old - step
        down = loss()
        x[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 0.1 * abs(g[at]) + 1e-4


def test_sample_is_bounded_in_bytes(documents, spark, monkeypatch):
    df = documents(["short text " * (1 + i % 5) for i in range(60)] + ["x" * 5000])
    labels = spark.createDataFrame([(i, i % 2) for i in range(61)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(byte_network, "TRAINING_BYTES", 700)
    monkeypatch.setattr(byte_network.ByteNetwork, "fit", lambda self, texts, labels: seen.append(texts) or self)
    byte_network.fit_quality(df, labels)
    byte_network.fit_quality(df.repartition(7), labels)
    # Whole texts, in an order of their own; the one that never fits is passed over.
    assert seen[0] == seen[1] and 600 < sum(map(len, seen[0])) <= 700 and all(t.startswith(b"short text ") for t in seen[0])


def plain_probability(network, text):
    """One place, filter and chunk at a time."""
    taps, block = byte_network.TAPS, byte_network.BLOCK
    blocks = (len(text) + taps - 1) // block + 1
    padded = text + bytes(blocks * block + taps - len(text))
    chunks = []
    first = 0
    while True:
        end = min(first + byte_network.CHUNK_BLOCKS, blocks)
        tops = []
        for f in range(byte_network.FILTERS):
            outputs = []
            for place in range(first * block, end * block):
                beyond = place >= blocks * block - taps + 1
                outputs.append(0.0 if beyond else sum(float(network.filters[k, padded[place + k], f]) for k in range(taps)))
            tops.append(max(0.0, max(outputs) + float(network.offset[f])))
        chunks.append(tops)
        if end == blocks:
            break
        first += byte_network.CHUNK_STEP
    mean = [sum(c[f] for c in chunks) / len(chunks) for f in range(byte_network.FILTERS)]
    most = [max(c[f] for c in chunks) for f in range(byte_network.FILTERS)]
    logit = float(network.bias[0]) + sum(float(w) * x for w, x in zip(network.weights, mean + most))
    return 1 / (1 + math.exp(-logit))


def test_forward_pass_like_a_plain_loop():
    """Filters over every place of overlapping chunks, the largest outputs of the text, one logistic unit."""
    network = byte_network.ByteNetwork()
    random = np.random.default_rng(3)
    network.weights += random.standard_normal(network.weights.shape).astype(np.float32)
    texts = [random.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 1, 4, 5, 300, 2000)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = network.probabilities(np.frombuffer(b"".join(texts), np.uint8), offsets)
    again = [network.probabilities(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(got, again, atol=1e-6)
    assert np.allclose(got, [plain_probability(network, t) for t in texts], atol=1e-4)


def test_network_odd_rows(odd, no_documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = byte_network.held_out_quality(odd, none).collect()
    assert len(rows) == odd.count() and all(x["score"] == 0.5 for x in rows)
    assert byte_network.held_out_quality(no_documents, none).count() == 0


WORDS = {"en": "the house river king water tree", "de": "das haus fluss könig wasser baum", "fr": "la maison rivière roi eau arbre"}


def test_languages(documents):
    r = random.Random(2)
    langs = [r.choice(list(WORDS)) for _ in range(200)]
    df = documents([" ".join(r.choice(WORDS[x].split()) for _ in range(12)) for x in langs]).drop("lang")
    df = df.join(df.sparkSession.createDataFrame(list(enumerate(langs)), "doc_id long, lang string"), "doc_id")
    rows = language.held_out_languages(df).collect()
    assert all(x["lang_pred"] == langs[x["doc_id"]] and x["score"] > 0.9 for x in rows)


def test_unseen_words_fall_back(documents):
    df = documents(["the house the house", "la maison la maison"]).drop("lang").selectExpr("*", "if(doc_id = 0, 'en', 'fr') AS lang")
    model = language.fit_languages(df)
    known, unseen = model.score("house"), model.score("thouse")
    assert known[0] > known[1] and unseen[0] > unseen[1]
    assert model.score("zzz") == (0.0, 0.0) or len(model.score("zzz")) == 2


def test_language_odd_rows(odd, no_documents):
    rows = language.held_out_languages(odd).collect()
    assert len(rows) == odd.count()
    assert {x["lang_pred"] for x in rows if x["doc_id"] in (1, 2, 7)} == {"und"}
    assert language.held_out_languages(no_documents).count() == 0
    assert language.predict_languages(odd, language.fit_languages(no_documents)).where("lang_pred <> 'und'").count() == 0


def test_every_training_word_and_gram_counts(documents):
    """However few words are at hand in the tasks: equal to a model of all words and n-grams."""
    r = random.Random(6)
    langs = [r.choice(list(WORDS)) for _ in range(60)]
    rare = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(150)]
    texts = [" ".join(r.choice(WORDS[x].split() + rare[i % 3 * 50 :][:50] * (i % 2)) for _ in range(6)) for i, x in enumerate(langs)]
    df = documents(texts).drop("lang").join(documents(["x"]).sparkSession.createDataFrame(list(enumerate(langs)), "doc_id long, lang string"), "doc_id")
    grams = lambda w, k: [f"_{w}_"[i : i + k] for i in range(len(w) + 3 - k)]
    names = sorted(set(langs[:40]))
    words = {x: Counter(w for t, y in zip(texts[:40], langs) if x == y for w in t.split()) for x in names}
    tables = {0: words} | {k: {x: sum((Counter({g: c * n for g, c in Counter(grams(w, k)).items()}) for w, n in words[x].items()), Counter()) for x in names} for k in range(1, 5)}

    def log(k, name):
        shares = [tables[k][x][name] / tables[k][x].total() for x in names]
        return [math.log((share + 0.1 * np.mean(shares)) / 1.1) for share in shares]

    def score(w):
        if any(w in words[x] for x in names):
            return log(0, w)
        for k in (4, 3, 2, 1):
            if found := [log(k, g) for g in grams(w, k) if any(g in tables[k][x] for x in names)]:
                return list(np.mean(found, 0))
        return [0.0] * len(names)

    assert score("xyz") != score("the")
    model = language.fit_languages(df.where("doc_id < 40"), words=1)
    got = {x["doc_id"]: x for x in language.predict_languages(df, model).collect()}
    assert len(model.at_hand) <= 3 and len(got) == 60
    for i, text in enumerate(texts):
        total = np.sum([score(w) for w in text.split()], 0)
        assert got[i]["lang_pred"] == names[total.argmax()]
        assert abs(got[i]["score"] - 1 / np.exp(total - total.max()).sum()) < 1e-6


def test_signs_for_numbers_are_no_letters(documents):
    df = documents(["½ ² ①", "Ⅷ x²y", "the house", "12 ٣ 三"]).drop("lang").selectExpr("*", "if(doc_id = 2, 'en', null) AS lang")
    got = {x["doc_id"]: x["lang_pred"] for x in language.predict_languages(df, language.fit_languages(df)).collect()}
    assert got == {0: "und", 1: "en", 2: "en", 3: "en"}
    assert language.words_of("½a½b²".encode()) == ["a", "b"] and language.words_of(b"") == []


def test_a_small_language_takes_nothing_from_others(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    few = ["Быстрая лиса прыгает через ленивую собаку.", "Сегодня хорошая погода в городе.", "Мы читаем книгу у реки."]
    russian = spark.createDataFrame([(-1 - i, t, "ru") for i, t in enumerate(few)], "doc_id long, text string, lang string")
    model = language.fit_languages(docs.where("lang IS NOT NULL").unionByName(russian))
    cuts = [(i, " ".join(r["text"].split()[7:10])) for i, r in enumerate(docs.where("lang = 'en' AND length(text) > 200").collect())]
    cuts += [(100_000, "my keyboard crashed yesterday"), (100_001, "hello world"), (100_002, "лиса читает")]
    got = {x["doc_id"]: x["lang_pred"] for x in language.predict_languages(spark.createDataFrame(cuts, "doc_id long, text string"), model).collect()}
    assert got.pop(100_002) == "ru" and "ru" not in got.values() and len(got) > 200


def test_equal_scores_go_to_the_first_language(documents):
    df = documents(["same words here"] * 4).drop("lang").selectExpr("*", "if(doc_id % 2 = 0, 'fr', 'de') AS lang")
    rows = language.predict_languages(df, language.fit_languages(df)).collect()
    assert {(x["lang_pred"], x["score"]) for x in rows} == {("de", 0.5)}


def test_word_in_most_documents_but_not_in_training(documents, monkeypatch):
    from actionlens.operators import hot_keys

    monkeypatch.setattr(hot_keys.join_per_key, "__defaults__", (10,))
    monkeypatch.setattr(language, "MIN_HOT_ROWS", 10)
    df = documents([f"house thouse w{i % 7}x" for i in range(300)]).drop("lang").withColumnRenamed("keep", "lang").selectExpr("* EXCEPT (lang)", "if(doc_id < 2, 'en', if(doc_id < 4, 'fr', null)) AS lang")
    df = df.selectExpr("* EXCEPT (text)", "if(doc_id < 2, 'the house', if(doc_id < 4, 'la maison', text)) AS text")
    rows = language.predict_languages(df, language.fit_languages(df.where("doc_id < 4"), words=0)).collect()
    assert len(rows) == 300 and {x["lang_pred"] for x in rows if x["doc_id"] >= 4} == {"en"}
