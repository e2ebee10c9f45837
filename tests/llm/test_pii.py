import hashlib
import os
import re
import subprocess
import sys
from pathlib import Path

import pytest

from payscope.llm import pii
from pyspark.sql import functions as F


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def values(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [(r.text, [(f.kind, f.value) for f in r.found]) for r in pii.pseudonymize(df, key).orderBy("doc_id").collect()]


def test_valid_values_stay_valid_and_the_rest_stays(spark):
    texts = [
        "card 4111111111111111, 4111-1111-1111-1111 and 4111 1111 1111 1111!",
        "wrong 4111111111111112 9870157079875996 1111111111111117 300.1.1.1 2024-02-30 000-12-3456 DE89370400440532013001 x4111111111111111 a@b",
        "2024-02-29 31.12.1999 12/31/2020 123-45-6789",
        "a.b@mail1.example.com THAT 233.233.171.252!! +1 (523) 555-1055.",
        "GB82 WEST 1234 5698 7654 32 DE89370400440532013000",
        "", None, "no numbers here", "$$$ 8.8.8.8%%% 4111111111111111###",
    ]
    got = values(spark, texts)
    assert got[1] == (texts[1], []) and got[5] == ("", []) and got[6] == (None, []) and got[7] == (texts[7], [])
    cards = [re.sub("[^0-9]", "", v) for k, v in got[0][1]]
    assert [k for k, _ in got[0][1]] == ["card"] * 3 and len(set(cards)) == 1 and luhn(cards[0]) and cards[0] != "4111111111111111"
    assert re.fullmatch(r"card \d{16}, \d{4}-\d{4}-\d{4}-\d{4} and \d{4} \d{4} \d{4} \d{4}!", got[0][0])
    assert [k for k, _ in got[2][1]] == ["date", "date", "date", "ssn"]
    assert [k for k, _ in got[3][1]] == ["email", "ip", "phone"] and got[3][0].endswith(".") and "@mail1.example.com THAT" in got[3][0]
    for _, v in got[4][1]:
        flat = v.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1
    assert [k for k, _ in got[4][1]] == ["iban", "iban"] and [k for k, _ in got[8][1]] == ["ip", "card"]


def test_keyed_and_linked(spark):
    a = values(spark, ["x 4111111111111111", "4111111111111111 y"])
    assert a[0][1] == a[1][1] and a == values(spark, ["x 4111111111111111", "4111111111111111 y"])
    assert values(spark, ["x 4111111111111111"], "other")[0][1] != a[0][1]


def test_permutation(spark):
    """Different values get different pseudonyms of the same form."""
    phones = [f"555-{n:03d}-0{n:03d}" for n in range(300)]
    dates = [f"{1900 + n % 200}-{n % 12 + 1:02d}-{n % 28 + 1:02d}" for n in range(300)]
    ips = [f"10.0.{n // 256}.{n % 256}" for n in range(300)]
    ssn = [f"{n % 665 + 1:03d}-{n % 99 + 1:02d}-{n % 9999 + 1:04d}" for n in range(300)]
    mails = [f"u{n}@x.org" for n in range(300)]
    for form, texts in ((r"\d{3}-\d{3}-\d{4}", phones), (r"\d{4}-\d\d-\d\d", dates), (r"[\d.]+", ips), (r"\d{3}-\d\d-\d{4}", ssn), (r"[a-z]\d+@x\.org", mails)):
        out = [t for t, found in values(spark, texts) if len(found) == 1]
        assert len(out) == 300 and len(set(out)) == len(set(texts)) and all(re.fullmatch(form, t) for t in out)


def test_small_domain_is_a_bijection(spark):
    df = spark.range(99 * 7).select((F.col("id") / 7).cast("long").alias("a"), (F.col("id") % 7).alias("b"))
    got = df.select(pii._feistel("k", "t", F.col("a"), F.col("b"), F.lit(99), F.lit(7)).alias("s")).select("s.a", "s.b").collect()
    assert {tuple(r) for r in got} == {(a, b) for a in range(99) for b in range(7)}


def test_other_columns_and_long_texts(spark):
    df = spark.createDataFrame([("x" * 300000 + " 8.8.8.8", 1, "y")], "text string, found int, _made string")
    with pytest.raises(ValueError, match="already"):
        pii.pseudonymize(df, "k")
    r = pii.pseudonymize(df, "k", found="private").collect()[0]
    assert r._made == "y" and r.found == 1 and [f.kind for f in r.private] == ["ip"] and r.text.startswith("x" * 300000)
    assert pii.pseudonymize(df.limit(0), "k", found="private").count() == 0


#: Each would repeat a group of some form as often as it is long.
ENDLESS = [
    "a@" + "b." * 500_000, "a@" + "b." * 500_000 + "com", "a." * 500_000 + "b@x.com", "a@b." * 250_000, "1.2.3.4." * 125_000,
    "2024-02-09-" * 90_000, "1/2/2024/" * 110_000, "123-45-6789-" * 83_000, "GB82 WEST " * 100_000, "A1B2 " * 200_000, "4111 " * 200_000,
    "4111-" * 200_000, "+1 555 " * 140_000, "(555) " * 160_000, "+1-" * 330_000, "1" * 1_000_000, "a" * 1_000_000 + "@", "@" * 1_000_000,
]


def test_endless_forms_in_a_fresh_session():
    """A stack that a warm engine has grown or compiled away hides an overflow, so this runs
    in a process of its own, with the stack that executors have."""
    code = (
        "import sys; sys.path[:0] = sys.argv[1:3]\n"
        "from pyspark.sql import functions as F\n"
        "from test_pii import ENDLESS, values\n"
        "from payscope.llm import pii\n"
        "from payscope.session import local_session\n"
        "spark = local_session(4, 'endless')\n"
        "got = values(spark, ENDLESS[:4])\n"
        "assert [[k for k, _ in f] for _, f in got] == [[], [], [], []]\n"
        "df = spark.createDataFrame([(t,) for t in ENDLESS], 'text string').repartition(8)\n"
        "n = df.select(F.regexp_count('text', F.lit(pii.PATTERN)).alias('n'), F.size(F.split('text', pii.PATTERN)).alias('m')).collect()\n"
        "assert len(n) == len(ENDLESS) and all(r.m == r.n + 1 for r in n)\n"
        "print('all')\n"
    )
    here = Path(__file__).resolve()
    done = subprocess.run([sys.executable, "-c", code, str(here.parents[2]), str(here.parent)], capture_output=True, text=True, timeout=200, env=os.environ | {"PYTHONPATH": str(here.parents[2])})
    assert done.returncode == 0 and "all" in done.stdout, done.stderr[-2000:]


def test_ends_of_hosts(spark):
    hosts = {"x.com": "", "x.com.": ".", "x.com.123": ".123", "1and1.co.uk": "", "a-b.x.org!": "!", "x.com,y": ",y", "x.com/1": "/1"}
    for (host, tail), (text, found) in zip(hosts.items(), values(spark, [f"to me@{h}" for h in hosts])):
        assert [k for k, _ in found] == ["email"], host
        assert text.endswith("@" + host) and found[0][1] == text.removeprefix("to ").removesuffix(tail)
    none = ["me@" + "a." * 127 + "com", "me@" + "a" * 64 + ".com", "me@x", "me@x.c", "m" * 65 + "@x.com"]
    assert values(spark, none) == [(t, []) for t in none]


def plain_pseudonym(key, kind, digits):
    """The permutation of a string of digits in plain Python, round by round."""
    left = len(digits) // 2
    a, b, m, n = int(digits[:left]), int(digits[left:]), 10**left, 10 ** (len(digits) - left)
    for r in range(pii.ROUNDS):
        keyed = int(hashlib.sha256(f"{key}|{kind}|{r}|{b}|{m}".encode()).hexdigest()[:15], 16)
        a, b, m, n = b, (a + keyed % m) % m, n, m
    return f"{a:0{left}d}{b:0{len(digits) - left}d}"


def test_phones_and_cards_by_a_plain_permutation(spark):
    phones = [f"555-{n:03d}-{n * 7 % 10000:04d}" for n in range(50)]
    for phone, (text, found) in zip(phones, values(spark, phones)):
        want = plain_pseudonym("k", "phone", phone.replace("-", ""))
        assert text == f"{want[:3]}-{want[3:6]}-{want[6:]}" and found == [("phone", text)]


def test_a_date_has_one_pseudonym_in_every_form(spark):
    forms = ["2024-02-09", "2024-02-09T10:00:00", "2024-02-09t10:00Z", "2024-2-9", "2024/02/09", "2024/2/9", "09.02.2024", "9.2.2024", "02/09/2024", "2/9/2024", "02/9/2024"]
    got = values(spark, [f"on {f}, so" for f in forms])
    days = set()
    for f, (text, found) in zip(forms, got):
        assert [k for k, _ in found] == ["date"], f
        value = found[0][1]
        assert text == f"on {value}{f[10:] if f[10:11] in ('T', 't') else ''}, so"
        parts = [int(p) for p in re.split(r"[-/.]", value)]
        days.add(tuple(parts if parts[0] > 31 else [parts[2], parts[1], parts[0]] if "." in value else [parts[2], parts[0], parts[1]]))
    assert len(days) == 1 and days != {(2024, 2, 9)}
    clear = ["2/30/2024", "2024/02/30", "1.2.2020.3", "30.2.2024", "2024-13-1", "2024-02-09x", "1/2/20201"]
    assert values(spark, clear) == [(t, []) for t in clear]
