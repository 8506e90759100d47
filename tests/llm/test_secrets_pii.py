import math
import random
import re
import time

from rowlint.llm import pii, secrets_scan

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        t += v - 9 if v > 9 else v
    return t % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


def base_pii(t):
    o = [("email", m.start(), m.end()) for m in EMAIL.finditer(t)]
    o += [("ip", m.start(), m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    o += [("card", m.start(), m.end()) for m in CARD.finditer(t) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    o += [("phone", m.start(), m.end()) for m in PHONE.finditer(t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(o, key=lambda x: (x[1], pii.BASE.index(x[0])))


def test_pii_against_plain_patterns(spark):
    random.seed(3)

    def fuzz():
        al = random.choice(["ab.@-+_%c1 ", "0123456789 -.+()", "12. -", "4 1-0é\U0001f600.", "a@b.c1+ 9"])
        return "".join(random.choice(al) for _ in range(random.randint(0, 80)))

    texts = [fuzz() for _ in range(3000)] + [None, "", "é" * 20 + "a@b.c +1 (683) 555-6293 x", "a@b_c@d.e", "x 4111111111111111 4111-1111-1111-1111",
                                             "a@b.c " * 500 + "+1 555 123 4567," * 300]
    df = spark.createDataFrame([(i, t, "q", "r") for i, t in enumerate(texts)], "doc_id long, text string, pii string, digit string")
    out = pii.with_pii(df)
    assert out.columns == ["doc_id", "text", "digit", "pii"]
    for r in out.collect():
        assert [(x["kind"], x["start"], x["end"]) for x in r["pii"] if x["kind"] in pii.BASE] == base_pii(r["text"] or "")


def test_pii_checksums_and_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 ok", "IBAN DE88 3704 0044 0532 0130 00 ok", "my ssn 123-45-6789", "number 123-45-6789", "card 4111 1111 1111 1111!",
             "order 4111 1111 1111 1111!"]
    got = [r["pii"] for r in pii.with_pii(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()]
    assert [(x["kind"], x["start"], x["end"]) for x in got[0]] == [("iban", 5, 32)] and got[1] == []
    assert [x["kind"] for x in got[2]] == ["ssn"] and got[3] == []
    assert got[4][0]["score"] > got[5][0]["score"]


def test_pii_long_runs_are_linear(spark):
    t0 = time.time()
    for hard in ["a" * 200000, "1" * 200000, "1 " * 100000, "a@" + "b." * 100000, "+1" + " " * 200000]:
        pii.with_pii(spark.createDataFrame([(1, hard)], "doc_id long, text string")).collect()
    assert time.time() - t0 < 60


def base_secrets(t):
    out = [("assign", m.start(), m.end()) for m in re.finditer(
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t)
        if len(m.group(2)) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 24]
    return sorted(out, key=lambda s: (s[1], secrets_scan.KINDS.index(s[0])))


def test_base_secrets_against_plain_patterns(spark):
    random.seed(5)
    parts = ["password", "PassWd", "SECRET", "token", "api_key", "apikey", "API_KEY", "=", ":", " ", '"', "'", "abc123", "x", "AKIA", "ABCDEFGHIJ0123456789", "deadbeef0123", "\n", "é", "ſecret"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(3000)] + [None, "", "password=" * 20000, "a=b+" * 20000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, secrets int")
    for r in secrets_scan.with_secrets(df).collect():
        assert [(x["kind"], x["start"], x["end"]) for x in r["secrets"] if x["kind"] != "literal"] == base_secrets(r["text"] or "")


def literals(text):
    return [(text[a:b], name) for kind, a, b, name, _ in secrets_scan.scan(text) if kind == "literal"]


def test_assignments_and_constants():
    assert literals('k = "Zk39fjQ0aPq81"\napi_secret = k\n') == [("Zk39fjQ0aPq81", "api_secret")]
    assert literals('{"client_secret": "a8f7K2m1Qz00", "name": "Zk39fjQ0aPq82"}') == [("a8f7K2m1Qz00", "client_secret")]
    assert literals("connect(password='p4ss' + \"W0rd!x9\", user='bob')") == [("p4ss", "password"), ("W0rd!x9", "password")]
    assert literals("DB_PASSWORD=hunter2abc99") == [("hunter2abc99", "DB_PASSWORD")]
    assert literals("password = ${DB_PASSWORD}\npassword: changeme\nThe secret: nobody knows") == []
    assert literals('label = "Zk39fjQ0aPq81"') == []


def test_growing_sums_stay_small():
    t0 = time.time()
    secrets_scan.scan('a = "x1y2z3"\n' + "".join(f"b{i} = b{i - 1} + b{i - 1}\n" if i else "b0 = a\n" for i in range(3000)) + "password = b2999")
    secrets_scan.scan('k = "x1"\n' + 'k = k + "y2"\n' * 5000)
    assert time.time() - t0 < 10


def test_every_sensitive_name_is_scanned():
    for word in sorted(secrets_scan.STRONG | secrets_scan.WEAK) + [f"{a}_{b}" for a, b in secrets_scan.PAIRS]:
        assert literals(f'{word} = "Abc123xyz987"') == [("Abc123xyz987", word)]
    name = "a." * 100 + "secret"
    assert literals(f'{{"{name}": "Abc123xyz987"}}') == [("Abc123xyz987", name)]


def test_long_sums_are_carried_on():
    parts = [f"aB{i}x9" for i in range(200)]
    long = " + ".join(f'"{p}"' for p in parts)
    assert literals(f'k = {long}\nsecret = k\n') == [(p, "secret") for p in parts]
    got = literals(f'k = "Zk39fjQ0aPq81"\nk = {long}\nsecret = k\n')
    assert got == [(p, "secret") for p in parts]  # not the earlier constant
    assert literals(f'k = {" + ".join([chr(34) + "x" * 9 + chr(34)] * 90)}\nsecret = k\n') == []  # a placeholder


def test_sums_of_sums_against_plain_strings():
    random.seed(9)
    t0 = time.time()
    for _ in range(400):
        alphabet = random.choice(["x", "xX", "ab", "abC1", "abcdefgh01", "<a>", "your_", "-9fZqL03"])
        leaves = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 12))) for _ in range(4)]
        lines, plain, uses = [], {}, {}
        for i, v in enumerate(leaves):
            lines.append(f'v{i} = "{v}"')
            plain[i], uses[i] = v, {i}
        for i in range(4, 9):
            a, b = random.randrange(i), random.randrange(i)
            lines.append(f"v{i} = v{a} + v{b}")
            plain[i], uses[i] = plain[a] + plain[b], uses[a] | uses[b]
        lines.append("password = v8")
        # the weight as the plain string has it
        value = plain[8]
        kinds = sum(bool(re.search(x, value)) for x in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
        entropy = -sum(value.count(c) / len(value) * math.log2(value.count(c) / len(value)) for c in set(value))
        w = 0.1 + 0.1 * (len(value) >= 16) + 0.1 * (kinds >= 2) + 0.15 * (entropy >= 3 - 1e-12)
        good = len(value) >= 6 and not secrets_scan.PLACEHOLDER.match(value) and 0.6 + w >= 0.7
        assert [x for x, _ in literals("\n".join(lines))] == [leaves[i] for i in range(4) if good and i in uses[8] and leaves[i]]
    doubling = 'v0 = "aB3dE6gH"\n' + "".join(f"v{i} = v{i - 1} + v{i - 1}\n" for i in range(1, 5000)) + "secret = v4999\n"
    assert literals(doubling) == [("aB3dE6gH", "secret")]
    many = "k = " + " + ".join(['"aB3dE6gH"'] * 20000) + "\n" + "secret = k\n" * 20000
    assert len(literals(many)) == 20000
    assert time.time() - t0 < 60
