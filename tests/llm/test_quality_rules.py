import math
import random
import re
from collections import Counter

import pytest

import pyarrow as pa

from actionlens.llm import quality_rules
from actionlens.llm.flat import steps

BASE = quality_rules.COUNTS[:5]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, twice = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            twice += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), twice, len(covered)


def test_counts():
    r = random.Random(3)
    texts = ["".join(r.choice(["a ", "b ", "é", "\n", "# ", "|", "\t", "one two three four five six seven eight "]) for _ in range(r.randint(0, 60))) for _ in range(400)]
    texts += [None, "", "\n", "x\ny\nx", "a " * 30, "a\na\n\n b\n b"]
    got = []
    for _, _, data, offsets in steps(pa.array(texts), 700):
        found = quality_rules.text_counts(data, offsets)
        got += list(zip(*(found[c].tolist() for c in BASE)))
    assert got == [brute(t) for t in texts]


CLEAN = "The house of the king is by the river and it was built for him. "
JUNK = ("WIN!! BIG!! PRIZES!! NOW!! ", "xq$$$ zw%%% kv&&& ", "home | login | about | ")


def test_verdicts(documents):
    r = random.Random(5)
    clean = [" ".join(r.sample(CLEAN.split() * 3, 30)) + "." for _ in range(200)]
    junk = ["".join(r.choice(kind.split(" ")[:-1]) + " " for _ in range(40)) for kind in JUNK for _ in range(10)]
    rows = quality_rules.judge_documents(documents(clean + junk)).orderBy("doc_id").collect()
    assert all(x["kept"] for x in rows[:200]) and not any(x["kept"] for x in rows[200:])
    assert all(0 <= x["posterior"] <= 1 for x in rows)


FOREIGN = (
    "Дом короля стоит у реки, и люди строили его много лет. Вода в реке была холодной, но дети любили там играть летом.",
    "Το σπίτι του βασιλιά είναι δίπλα στο ποτάμι και οι άνθρωποι το έχτιζαν πολλά χρόνια. Το νερό ήταν κρύο αλλά τα παιδιά έπαιζαν εκεί.",
    "राजा का घर नदी के पास है और लोगों ने इसे कई साल तक बनाया। नदी का पानी ठंडा था लेकिन बच्चे वहाँ खेलते थे।",
    "يقع بيت الملك قرب النهر وقد بناه الناس في سنوات كثيرة. كان الماء باردا لكن الأطفال أحبوا اللعب هناك في الصيف، أليس ذلك جميلا؟",
    "왕의 집은 강 옆에 있고 사람들은 그것을 여러 해 동안 지었다. 강물은 차가웠지만 아이들은 여름에 거기서 노는 것을 아주 많이 좋아했다.",
    "Rumah raja berdiri dekat sungai, lalu banyak orang membangunnya selama bertahun-tahun. Airnya dingin, tetapi anak-anak senang bermain di sana setiap musim panas.",
)


def test_prose_of_unlisted_languages_is_kept(documents):
    r = random.Random(5)
    clean = [" ".join(r.sample(CLEAN.split() * 3, 30)) + "." for _ in range(200)]
    junk = ["".join(r.choice(kind.split(" ")[:-1]) + " " for _ in range(40)) for kind in JUNK for _ in range(10)]
    df = documents([*FOREIGN, *clean, *junk])
    rows = quality_rules.judge_documents(df).orderBy("doc_id").collect()
    assert all(x["n_words"] >= quality_rules.MIN_WORDS and x["n_ended_lines"] == 1 for x in rows[: len(FOREIGN)])
    assert all(x["kept"] for x in rows[:206]) and not any(x["kept"] for x in rows[206:])
    assert quality_rules.keep_good(df).count() == 206


UNSPACED = (
    "国王的房子在河边，人们花了很多年才把它建成。河里的水很冷，但是孩子们喜欢在那里玩耍。",
    "王様の家は川のそばにあり、人々は何年もかけてそれを建てました。川の水は冷たかったが、子供たちはそこで遊ぶのが好きだった。",
    "บ้านของกษัตริย์อยู่ริมแม่น้ำและผู้คนสร้างมันมาหลายปี น้ำในแม่น้ำเย็นแต่เด็กๆชอบเล่นที่นั่นในฤดูร้อน",
)


def test_prose_of_scripts_without_blanks_is_kept(documents):
    r = random.Random(6)
    texts = ["\n".join(r.sample([x + str(i) + y for i in range(40) for x, y in [text.split(text[len(text) // 2], 1)]], 30)) for text in UNSPACED]
    clean = [" ".join(r.sample(CLEAN.split() * 3, 30)) + "." for _ in range(200)]
    junk = ["".join(r.choice(kind.split(" ")[:-1]) + " " for _ in range(40)) for kind in JUNK for _ in range(10)]
    for df in (documents([*texts, *clean, *junk]), documents(texts)):
        rows = quality_rules.judge_documents(df).orderBy("doc_id").collect()
        assert all(x["n_words"] >= 20 and x["kept"] and x["posterior"] > 0.9 for x in rows[:3])


def em_by_hand(patterns, rounds=3000, weight=0.05):
    """The same estimate a document at a time, in plain numbers."""
    shares, rates = quality_rules.assumptions()
    assumed_shares, assumed_rates = dict(shares), {k: dict(v) for k, v in rates.items()}
    imagined = weight * len(patterns)
    for _ in range(rounds):
        rows = []
        for votes in patterns:
            joint = {k: math.log(shares[k]) + sum(math.log(rates[k][r] if v < 0 else 1 - rates[k][r]) for r, v in votes.items() if v) for k in shares}
            top = max(joint.values())
            total = sum(math.exp(x - top) for x in joint.values())
            rows.append({k: math.exp(x - top) / total for k, x in joint.items()})
        for k in shares:
            shares[k] = (sum(p[k] for p in rows) + imagined * assumed_shares[k]) / (len(patterns) * (1 + weight))
            for r in rates[k]:
                m = imagined * assumed_shares[k]
                bad = sum(p[k] for p, v in zip(rows, patterns) if v[r] < 0)
                rates[k][r] = (bad + m * assumed_rates[k][r]) / (sum(p[k] for p, v in zip(rows, patterns) if v[r]) + m)
    return shares, rates


def test_estimates_like_plain_expectation_maximisation(documents):
    r = random.Random(9)
    clean = [" ".join(r.sample(CLEAN.split() * 3, 30)) + "." * (i % 9 > 0) for i in range(60)]
    junk = ["".join(r.choice(kind.split(" ")[:-1]) + " " for _ in range(40)) for kind in JUNK for _ in range(5)]
    counted = quality_rules.with_counts(documents([*FOREIGN, *clean, *junk]), ["doc_id"])
    passed = quality_rules.with_votes(counted.where(~quality_rules._failed()))
    patterns = [{rule: x[rule] for rule in quality_rules.votes()} for x in passed.collect()]
    model = quality_rules.fit_rules(counted)
    shares, rates = em_by_hand(patterns, 300)
    assert model.shares == pytest.approx(shares, rel=1e-5)
    for kind in rates:
        assert model.rates[kind] == pytest.approx(rates[kind], rel=1e-5)
    assert sum(shares.values()) == pytest.approx(1)


def test_one_bad_vote_is_outvoted(documents):
    """A text that repeats itself a little but is well otherwise is kept; so is one whose function words are not
    listed. A kind of junk that several rules notice is not."""
    r = random.Random(7)
    vocabulary = [a + b for a in ("ri", "wa", "kin", "tre", "ho", "mo") for b in ("ver", "ter", "ged", "ing", "use", "on", "al")]
    plain = lambda n: " ".join(w for _ in range(n // 3) for w in (*r.sample(vocabulary, 2), r.choice(["the", "of", "and"])))
    clean = [plain(60) + "." for _ in range(200)]
    block = plain(12)
    repeats = plain(36) + " " + block + ". " + plain(30) + " " + block + "."
    unlisted = " ".join(r.choice(vocabulary) for _ in range(40)) + "."
    junk = ["".join(r.choice(kind.split(" ")[:-1]) + " " for _ in range(40)) for kind in JUNK for _ in range(10)]
    df = documents([repeats, unlisted, *clean, *junk])
    counted = quality_rules.with_votes(quality_rules.with_counts(df, ["doc_id"]))
    votes = {x["c0"]: [x[rule] for rule in quality_rules.votes()] for x in counted.collect()}
    assert votes[0].count(-1) == votes[1].count(-1) == 1 and votes[0].count(1) >= 6 and votes[1].count(1) >= 6
    rows = {x["doc_id"]: x for x in quality_rules.judge_documents(df).collect()}
    assert rows[0]["kept"] and rows[1]["kept"] and not any(rows[i]["kept"] for i in range(202, 232))
    assert all(rows[i]["kept"] for i in range(2, 202))


def test_labelled_documents(spark):
    """Held against labels that the estimate does not see."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    rows = quality_rules.judge_documents(docs).join(labels, "doc_id").where("NOT base_failed AND quality IS NOT NULL").collect()
    clean, junk = ([x["kept"] for x in rows if x["quality"] == q] for q in (1, 0))
    assert all(clean) and len(clean) > 200 and sum(junk) <= 0.05 * len(junk) + 1


def test_odd_rows(odd, no_documents):
    rows = quality_rules.judge_documents(odd).collect()
    assert len(rows) == odd.count() and all(x["base_failed"] and not x["kept"] for x in rows if x["n_words"] < 20)
    assert quality_rules.judge_documents(no_documents).count() == 0
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    assert quality_rules.keep_good(no_documents).count() == 0
