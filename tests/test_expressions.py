from datetime import datetime

from pyspark.sql import functions as F

from ebbline.functions import expressions as e
from ebbline.functions.lookups import level_id, like_matches


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_yes_no(spark):
    got = one(spark, *[e.yes_no(F.lit(w)).alias(f"c{i}") for i, w in enumerate(("yes", " Y ", "1", "No", "0", "x"))])
    assert got == (True, True, True, False, False, None)


def test_name_part(spark):
    name = F.lit("srv.db.dbo.Logs")
    assert one(spark, *[e.name_part(name, i).alias(f"p{i}") for i in (1, 2, 3, 4, 5)]) == ("Logs", "dbo", "db", "srv", None)


def test_hours_are_exact(spark):
    got = one(spark, (e.ts_ntz("2024-03-01 00:00:00") - e.hours(-25)).alias("x"))
    assert got == (datetime(2024, 2, 28, 23),)


def test_like_pattern(spark):
    assert one(spark, e.like_pattern(F.lit("  Ab*C "))) == ("ab%c",)
    assert len(one(spark, e.like_pattern(F.lit("x" * 300)))[0]) == 300


def test_levels(spark):
    words = (" Error ", "5", "9", "none")
    assert one(spark, *[level_id(F.lit(w)).alias(f"c{i}") for i, w in enumerate(words)]) == (4, 5, None, None)


def test_like_matches_equals_brute_force(spark):
    names = ["Nation_1", "NATION_12", "nationX1", "abc", "a_c", "", "back\\slash", "x%y", "_", "a" * 130, "y" * 130, "x" * 126 + "a_prod", "x" * 126 + ".._test"]
    patterns = ["nation_1", "nation%", "nation_1%", "%1", "%", "_", "___", "a_c", "abc%", "%a%c%", "back\\slash", "back\\%", "", "x%y", "a" * 128, "x" * 126 + "%_prod", "y" * 130]

    def matches(text, pattern):
        if not pattern:
            return not text
        if pattern[0] == "%":
            return any(matches(text[i:], pattern[1:]) for i in range(len(text) + 1))
        return bool(text) and pattern[0] in ("_", text[0]) and matches(text[1:], pattern[1:])

    got = like_matches(spark.createDataFrame([(p,) for p in patterns * 2], "pattern string"),
                       spark.createDataFrame([(n,) for n in names], "name string"), "name").collect()
    want = sorted((p, n) for p in patterns for n in names if matches(n.lower(), p))
    assert sorted((r.pattern, r.name) for r in got) == want


def test_long_strings_are_marked(spark):
    text = "c" * 100_000 + '\\"' + "d" * 100_000
    doc, odd = '{"comment": "' + text + '", "n": 1}', '{"a": "' + "e" * 100_000
    marked = one(spark, e.mark_json_strings(F.lit(doc)))[0]
    assert marked == '{"s:comment": "s:' + text + '", "s:n": 1}'
    assert one(spark, e.mark_json_strings(F.lit(odd)))[0].startswith('{"s:a": "')
