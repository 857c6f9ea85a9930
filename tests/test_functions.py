"""Text expressions against Python's own str / int / float behaviour and
against worked examples."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import text as T


ATOMS = ["1", "0", "12", "-3", "+4", "1_000", "_1", "1__0", "1.5", ".5", "5.", "1e5", "1E-3",
         "e5", "inf", "-Infinity", "nan", "NaN", "5d", "0x10", "true", "No", "YES", "a@b.c",
         "a@b", "@.", "2024-01-05", "2024/1/5", "05.01.2024", "--", "1-2", " ", "\t", "\x1c",
         "abc", "null", "None", "x y", "ü", "٣", "2024-13-45x", "a.b.c.d.e", "", "1 000",
         "\u2003", "\xa0", "\x85", "\u3000", "\u200b", "\x0b"]


def gen(n=1500, seed=7):
    rnd = random.Random(seed)
    out = set(ATOMS)
    while len(out) < n:
        k = rnd.randint(1, 3)
        s = "".join(rnd.choice(ATOMS) for _ in range(k))
        if rnd.random() < 0.3:
            s = rnd.choice([" ", "\t", "\n", "\x1f", ""]) + s + rnd.choice([" ", "\r\n", ""])
        out.add(s)
    return sorted(out)


def test_strip_numbers_and_alnum_are_pythons_own(spark):
    """On generated strings: strip, isalnum, and which texts int and float
    accept, asked of Python itself."""
    def accepts(f, v):
        try:
            f(v)
        except ValueError:
            return False
        return True

    vals = [v for v in gen() if not any(ch.isdigit() and not ch.isascii() for ch in v)]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    s = T.py_strip("v")
    got = df.select("v", s.alias("s"), T.guess_type(s).alias("t"), T.is_alnum(s).alias("a"))
    for r in got.collect():
        assert r.s == r.v.strip(), r
        if r.s:
            assert r.a == r.s.isalnum(), r
            assert (r.t == "integer") == accepts(int, r.s), r
            assert (r.t in ("integer", "float")) == accepts(float, r.s), r


# text -> the class it falls in, worked out by hand
CLASSES = {
    "12": "integer", "-3": "integer", "+4": "integer", "1_000": "integer", "1": "integer",
    "1.5": "float", ".5": "float", "5.": "float", "1E-3": "float", "-Infinity": "float",
    "true": "boolean", "No": "boolean", "YES": "boolean",
    "a@b.c": "email", "@.": "email", "x@y.z-2024": "email",
    "2024-01-05": "date", "2024/1/5": "date", "05.01.2024": "date", "a.b.c.d.e": "date",
    "1-2": "string", "--": "string", "a@b": "string", "abc": "string", "0x10": "string",
    "_1": "string", "1__0": "string", "1 000": "string", "x y": "string",
}
MISSING = {None: True, "": True, " \t": True, "null": True, " NaN ": True, "None": True,
           "NULL": True, "0": False, "nullx": False, "none.": False, "x": False}
DATES = {"2024-01-05": True, "1-2": True, "1.5": True, "2024/1/5": True,
         "abc": False, "--": False, "2024/1/": False, "- 1": False}
EMAILS = {"a@b.c": True, "@.": True, "a@b": False, "a.b": False, "a@@b.c": False}


@pytest.mark.parametrize("expected,test", [
    (CLASSES, T.guess_type), (MISSING, T.is_missing_text), (DATES, T.is_valid_date_shape),
    (EMAILS, T.is_valid_email)], ids=["class", "missing", "date", "email"])
def test_worked_examples(spark, expected, test):
    df = spark.createDataFrame([(k,) for k in expected], "v string")
    assert {r.v: r.x for r in df.select("v", test(F.col("v")).alias("x")).collect()} == expected


def test_non_ascii_digits_are_the_documented_deviation(spark):
    r = spark.createDataFrame([("٣",)], "v string").select(T.guess_type("v")).first()[0]
    assert r == "string"      # Python int('٣') == 3; documented in functions/text.py


@pytest.mark.parametrize("v,num", [("1_000", 1000.0), (" 2.5 ", 2.5), ("-0", 0.0), ("5d", None),
                                   ("0x10", None), ("abc", None), ("1e3", 1000.0)])
def test_to_number(spark, v, num):
    assert spark.createDataFrame([(v,)], "v string").select(T.to_number("v")).first()[0] == num
