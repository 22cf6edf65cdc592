"""Text, money, date and pattern functions against plain Python on random strings."""

import datetime as dt
import random
import re
import time
import unicodedata
from pathlib import PurePosixPath

from pyspark.sql import functions as F

from foliospark import rules
from foliospark.functions import dates as D
from foliospark.functions import money as M
from foliospark.functions import patterns as P
from foliospark.functions import text as T


def evaluate(spark, values, column, schema="s STRING"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i INT, " + schema).select("i", column(F.col("s")).alias("r"))
    return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def random_strings(alphabet, n, longest, seed=7):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


MIXED = list("abzABZ09 -'&.,()\t\n\r_éßÉñ") + [" ", " ", "\x1c", "ǆ", "中", "K"]


def test_strip_and_collapse(spark):
    values = random_strings(MIXED, 400, 12) + ["", " ", "　x　"]
    assert evaluate(spark, values, T.strip) == [v.strip() for v in values]
    assert evaluate(spark, values, T.collapse_whitespace) == [" ".join(v.split()) for v in values]
    assert evaluate(spark, values, T.is_blank) == [not v.strip() for v in values]


def test_title_case(spark):
    values = random_strings(MIXED, 400, 14) + ["o'neil 3d-x", "ACME (uk) ltd", "straße élan"]
    assert evaluate(spark, values, T.title_case) == [v.title() for v in values]


def test_truncate(spark):
    values = random_strings(MIXED, 100, 60)
    limit = (20, 0.6, 0.4)

    def expected(s):
        return s if len(s) <= 20 else s[:12] + "\n...\n" + s[-8:]

    assert evaluate(spark, values, lambda c: T.truncate_head_tail(c, limit)) == [
        expected(v) for v in values
    ]


def test_path_parts(spark):
    names = random_strings(list("ab.. -"), 300, 8) + ["a.b.pdf", ".bashrc", "noext", "x.", "A.PDF"]
    names = [n for n in names if n.strip(".")]
    paths = [PurePosixPath("/r/" + n) for n in names]
    assert evaluate(spark, names, T.stem) == [p.stem for p in paths]
    assert evaluate(spark, names, T.suffix) == [p.suffix for p in paths]
    assert evaluate(spark, ["/r/a/b.txt"], T.parent) == ["/r/a"]
    assert evaluate(spark, ["/r/a/b.txt"], T.file_name) == ["b.txt"]
    assert evaluate(spark, ['a/b:c<>"\\|?*'], T.folder_safe) == ["a_b_c_______"]


def test_money(spark):
    def expected(s):
        try:
            v = float(re.sub(r"[$,]", "", s))
        except ValueError:
            return None
        return v if v == v and abs(v) != float("inf") else None

    values = random_strings(list("0123456789$,._-+eE d"), 600, 7) + [
        "$1,234.50", " 12 ", "nan", "inf", "12d", "1_000", "1__0", "n/a", "", "1e5", ".5", "5.",
    ]
    got = evaluate(spark, values, M.parse_money)
    want = [expected(v) for v in values]
    want = [None if w is not None and abs(w) == float("inf") else w for w in want]
    got = [None if g is not None and abs(g) == float("inf") else g for g in got]
    assert got == want


def test_iso_timestamp(spark):
    def expected(s):
        try:
            v = dt.datetime.fromisoformat(s.replace("Z", ""))
        except ValueError:
            return None
        return None if v.tzinfo else v

    values = [
        "2024-06-10", "20240610", "2024-06-10T00:00:00Z", "2024-06-10T00:00:00+01:00", "soon",
        "2024", "2024-6-1", "2024-06-10 12:30", "2024-06-10T12", "2024-06-10T12:30:15.25",
        "2024-06-10T12:30:15.1234567", "20240610T123015", "2024-02-30", "", "2024-06-10T25:00",
        "2024-06-10x10:11:12", "20240610T1230",
    ]
    assert evaluate(spark, values, D.iso_timestamp) == [expected(v) for v in values]


def test_days_between(spark):
    values = ["2024-06-01", "2024-06-02", "2024-08-31", "2024-09-01", "2024-05-30"]
    now = dt.datetime(2024, 6, 1, 12)

    def days(c):
        return D.days_between(F.lit("2024-06-01 12:00:00").cast("timestamp_ntz"), D.iso_timestamp(c))

    assert evaluate(spark, values, days) == [
        (dt.datetime.fromisoformat(v) - now).days for v in values
    ]
    assert evaluate(spark, values, days)[:4] == [-1, 0, 90, 91]


def test_loose_date(spark):
    cases = {
        "25/12/2024": "2024-12-25", "03/04/2024": "2024-03-04", "3.4.24": "2024-03-04",
        "13-13-2024": None, "2024-03-04": "2024-03-04", "2024/12/1": "2024-12-01",
        "2024/25/12": None, "4 Mar 2024": "2024-03-04", "15 January 2024": "2024-01-15",
        "Mar 4, 2024": "2024-03-04", "september  9 1999": "1999-09-09", "Sept 9 1999": "1999-09-09",
        "31 Feb 2024": None, "1/2/80": "1980-01-02", "1/2/73": "2073-01-02", "1/2/74": "1974-01-02",
        "45/10/12": "2045-10-12", "4 Marble 2024": None, "0/5/2024": None,
    }
    got = evaluate(spark, list(cases), lambda c: D.loose_date(c, 2024))
    assert dict(zip(cases, got)) == cases


def test_dates_among_words(spark):
    cases = {
        "Friday, 5 Jan 2024": "2024-01-05", "the 5th of January, 2024": "2024-01-05", "2nd Feb. 2024": "2024-02-02",
        "January 5th 2024 at 10:30 p.m.": "2024-01-05", "issued 2024-01-05T10:30:00": "2024-01-05", "due: 20240105": "2024-01-05",
        "12 2024 Feb": "2024-02-12", "2024 5 Mar": "2024-03-05", "Dec 24 '99": "1999-12-24", "Sun 03.04.24 8:05": "2024-03-04",
        "25.12.2024 (Wed)": "2024-12-25", "Invoice 55 of 5 Jan 2024": None, "Jan 2024": None, "5/6": None, "": None, None: None,
        "words only": None, "5 Jan 2024 or 6 Jan 2024": None, "99999999999999 1 2": None, "1 2 99999999999": None,
        "2024-W01-1": "2024-01-01", "week 2020w537": "2021-01-03", "2024-w10": "2024-03-04", "2021-W53-1": None, "2024-W00-1": None,
        "2020-W53-7 (Sunday)": "2021-01-03", "2024-W54": None,
    }
    got = evaluate(spark, list(cases), lambda c: D.loose_date(c, 2024))
    assert dict(zip(cases, got)) == cases


def test_week_dates_equal_the_calendar(spark):
    days = [dt.date(1999, 1, 1) + dt.timedelta(days=13 * i) for i in range(1200)]
    texts = ["{}-W{:02}-{}".format(*d.isocalendar()) for d in days]
    assert evaluate(spark, texts, lambda c: D.loose_date(c, 2024)) == [d.isoformat() for d in days]


TOKENS = [
    "invoice", "INVOICE", "no", "number", "num", "#", ".", "-", "_", " ", "\n", "total", "balance",
    "amount", "due", "date", "vat", "registration", "$", "1,234.50", "7.00", "2024-05-06", "3/4/24",
    "4123456789", "44123456789", "INV-00001", "AB", "notification", "é", " ", ":", "12345",
]


def test_first_lead_patterns_equal_plain_search(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(TOKENS) for _ in range(rnd.randint(1, 25))) for _ in range(1500)]
    for fields in rules.FIELD_PATTERNS.values():
        for pattern in fields.values():
            def want(t, p=pattern):
                m = re.search(p, t, re.IGNORECASE)
                return m.group(1) if m else ""

            got = evaluate(spark, texts, lambda c, p=pattern: P.search(c, P.commit_to_first_lead(p)))
            assert got == [want(t) for t in texts], pattern


HEADER_TOKENS = TOKENS + [
    "inv", "bill", "reference", "grand", "company", "vendor", "from", "to", "Jan", "March", "4",
    "Acme & Sons, Ltd.", "TRADING HOUSE AB", "2024", "\r\n", "tax", "(19%)", "  ", " \n \n", "\t",
    "\nNORTHERN TRADING\n", "sales", "ABCDEFGHIJ KLM",
]


def test_ranked_search_equals_plain_search(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(HEADER_TOKENS) for _ in range(rnd.randint(1, 25))) for _ in range(4000)]
    fields = {
        "number": rules.INVOICE_NUMBER_PATTERNS, "date": rules.INVOICE_DATE_PATTERNS,
        "total": rules.INVOICE_TOTAL_PATTERNS, "vendor": rules.VENDOR_PATTERNS,
        "tax": rules.TAX_PATTERNS,
    }
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
    rows = sorted(P.with_ranked_search(df, "text", fields).collect(), key=lambda r: r["i"])

    def want(t, patterns):
        for rank, p in enumerate(patterns):
            m = re.search(p, t, re.IGNORECASE | re.MULTILINE)
            if m:
                return m.group(1), rank
        return None, None

    for name, patterns in fields.items():
        assert [(r[name], r[name + "_rank"]) for r in rows] == [want(t, patterns) for t in texts]


def test_long_runs_of_space_are_harmless(spark):
    gap, lines = " " * 4000, "\n" * 60000
    texts = [f"total{gap}amount{gap}:{gap}x", f"invoice no{gap}:{gap}!", lines + "x1", f"tax{gap}:{gap}$"]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
    fields = {
        "number": rules.INVOICE_NUMBER_PATTERNS, "total": rules.INVOICE_TOTAL_PATTERNS,
        "vendor": rules.VENDOR_PATTERNS, "tax": rules.TAX_PATTERNS, "date": rules.INVOICE_DATE_PATTERNS,
    }
    start = time.monotonic()
    rows = P.with_ranked_search(df, "text", fields).drop("text").collect()
    assert all(r[f] is None for r in rows for f in fields)
    assert time.monotonic() - start < 30


def test_samples_are_normalised():
    assert all(unicodedata.normalize("NFC", t) == t for t in TOKENS)
