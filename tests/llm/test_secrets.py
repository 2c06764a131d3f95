import hashlib
import math
import random
import re

from actionlens.llm import secrets

PATTERNS = (
    ("assign", re.compile(secrets.ASSIGN, re.A), lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)


def brute(text):
    spans = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(PATTERNS) for m in p.finditer(text or "") if ok(m))
    written = ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in spans)
    return (*(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(written.encode()).hexdigest())


def check(df):
    got = [(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in secrets.find_secrets(df).collect()]
    want = [(r["doc_id"], *brute(r["text"])) for r in df.select("doc_id", "text").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_patterns(documents):
    r = random.Random(4)
    parts = ["password", "Token", "=", ": ", "'", '"', "api_key", "APIKEY:", "AKIA", "ABCD1234EFGH", "0123456789abcdef", "é😀", " ", "\n", "abcd.efgh", "secret=", "x"]
    check(documents(["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(400)] + ["token=token: abcdefgh"]))


def test_odd_rows(odd, no_documents):
    check(odd)
    assert secrets.find_secrets(no_documents).count() == 0


def test_random_tokens_are_found_and_words_are_not(documents):
    r = random.Random(9)
    code = lambda letters, n: "".join(r.choice(letters) for _ in range(n)) + "7"
    hidden = [code("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 43) for _ in range(40)]
    plain = ["section_of_the_report_of_the_year_2024_and_the_rest", "a" * 30 + "1", "0101010101010101010101010101", "aaaabbbbccccddddeeeeffff0000"]
    df = documents([f"see {x} there" for x in hidden + plain * 10])
    rows = {x["doc_id"]: x["spans"] for x in secrets.find_secrets(df).collect()}
    found = sum("random:4:48" in rows[i] for i in range(40))
    assert found >= 36
    assert not any("random" in rows[i] for i in range(40, len(rows)))


def test_keys_in_paths_and_without_digits(documents):
    r = random.Random(10)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    key = lambda n, more: "".join(r.choice(letters + more) for _ in range(n))
    in_path = [(x, k) for _ in range(20) for x, k in (("/reset-password/", key(43, "0123456789") + "7"), ("/my_app/hooks/", key(43, "0123456789") + "7"), ("a_b-", key(21, "0123456789") + "+/" + key(21, "0123456789")))]
    no_digit = [("see ", key(24, "")) for _ in range(20)]
    plain = ["/our-company/a_page/about_the_history_of_the_town", "internationalisierungen", "INTERNATIONALIZATIONS", "donaudampfschifffahrtsgesellschaft", "-" * 30, "getTheNumberOfTheElementsOfTheTree", "one-of-the-best-of-the-rest"]
    df = documents([f"{x}{k} there" for x, k in in_path + no_digit] + [f"see {x} there" for x in plain * 10])
    rows = {x["doc_id"]: x["spans"].split(",") for x in secrets.find_secrets(df).collect()}
    found = [f"random:{len(x)}:{len(x + k)}" in rows[i] for i, (x, k) in enumerate(in_path + no_digit)]
    assert sum(found[:60]) >= 54 and sum(found[60:]) >= 17
    assert not any("random" in s for i in range(80, len(rows)) for s in rows[i])


def test_no_python_on_the_way(documents):
    plan = secrets.scan_texts(documents(["x"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_battery(token):
    """Encoding and p-values of one token, step by step."""
    encoding = next((e for e, (_, letters) in secrets.ENCODINGS.items() if re.fullmatch(letters, token)), None)
    if encoding is None:
        return None
    alphabet = secrets.ENCODINGS[encoding][0]
    n, k = len(token), len(alphabet)
    codes = [alphabet.index(c) for c in token]
    chi = sum((codes.count(c) - n / k) ** 2 / (n / k) for c in range(k))
    upper = lambda z: math.erfc(z / math.sqrt(2)) / 2
    p_uniform = upper((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))
    high = [c >= k / 2 for c in codes]
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    both = 2 * sum(high) * (n - sum(high))
    variance = both * (both - n) / (n * n * (n - 1))
    p_runs = 2 * upper(abs(runs - both / n - 1) / math.sqrt(variance)) if variance > 0 else 0.0
    mean = sum(codes) / n
    spread = sum((c - mean) ** 2 for c in codes)
    lagged = sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:]))
    p_serial = 2 * upper(abs(lagged / spread + 1 / n) * math.sqrt(n)) if spread > 0 else 0.0
    half = -sum(math.log(max(p, 1e-300)) for p in (p_uniform, p_runs, p_serial))
    p = math.exp(-half) * (1 + half + half * half / 2)
    if encoding in secrets.ONE_CASE and not re.search("[0-9]", token):
        p = min(1.0, 2 * min(p, (1 - sum(c.isdigit() for c in alphabet) / k) ** n))
    return encoding, p_uniform, p_runs, p_serial, p


def some_tokens(r, count):
    letters = ["0123456789abcdef", "ABCDEF0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcXYZ019+/", "abcXYZ-_9", "aab", "a"]
    out = []
    for _ in range(count):
        chosen, n = r.choice(letters), r.randint(20, 90)
        token = "".join(r.choice(chosen) for _ in range(n))
        out.append("".join(sorted(token)) if r.random() < 0.2 else token)
    return out


def test_battery_like_plain_arithmetic(spark):
    tokens = some_tokens(random.Random(12), 300) + ["-" * 20, "a+b-" * 9, "0" * 25]
    got = {x["token"]: x for x in secrets.battery(spark.createDataFrame([(t,) for t in tokens], "token string")).collect()}
    for token in tokens:
        want = plain_battery(token)
        assert (want is None) == (token not in got)
        if want:
            assert got[token]["encoding"] == want[0]
            for name, x in zip(("p_uniform", "p_runs", "p_serial", "p"), want[1:]):
                assert abs(got[token][name] - x) <= 1e-9 + 1e-6 * x


def test_random_spans_like_a_plain_step_up_rule(documents):
    r = random.Random(13)
    tokens = some_tokens(r, 250)
    df = documents([f"x {t} y" for t in tokens])
    got = {x["doc_id"]: "random" in x["spans"] for x in secrets.find_secrets(df).collect()}
    strata = {}
    for i, token in enumerate(tokens):
        scored = plain_battery(token)
        if scored:
            bin_of = min(30_000, math.floor(-math.log10(max(scored[4], 1e-300)) / 0.01))
            key = scored[0], bool(re.search("[0-9]", token)), math.floor(math.log2(len(token)))
            strata.setdefault(key, []).append((bin_of, i))
    want = dict.fromkeys(range(len(tokens)), False)
    for members in strata.values():
        # The step-up rule, every p as large as its bin allows.
        rejected = 0
        ordered = sorted(members, reverse=True)
        for rank in range(1, len(ordered) + 1):
            last_of_bin = rank == len(ordered) or ordered[rank][0] != ordered[rank - 1][0]
            if last_of_bin and 10 ** (-0.01 * ordered[rank - 1][0]) <= 0.05 * rank / len(ordered):
                rejected = rank
        for _, i in ordered[rejected:]:
            want[i] = True
    fits = [i for i, t in enumerate(tokens) if plain_battery(t)]
    assert [got[i] for i in fits] == [want[i] for i in fits] and 20 < sum(want.values()) < 230
