import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import model
from clamor.functions import accents
from clamor.functions import lexicon as lx
from clamor.functions import text as tx

ODD = [
    "", " ", "...", "....", "!!!", "?!...", ",,,", "a,b", "RT rt", "@user_1 hola", "@", "#",
    "http://x.y/z?q=1,2 fin", "www.a.b. c", "wWw.Upper.COM x", "half ½ and ﬁne … yes…no",
    "℡ ™ ⅷ ㎏ ①②", "한국어 텍스트", "日本語 カタカナ ｶﾞ", "العربية", "ΑΣ ΆΈ", "İstanbul ı", "ÀÉÎÕÜ ñÑ çÇ ß æ",
    "éä ô", "a b c　d", "tab\tnew\nline\rx", "it's #tag_1 'quoted'",
    "sin embargo", "sin  embargo", "sin @u embargo", "sin, embargo", "vino obstante", "no obstantes",
    "that saidx", "dicho estos", "en resumenes", "__pausa__ __coma__", "contrastomarcador",
    "😡🎉 👩‍👩‍👧", "x" * 50, "1º 2ª x²", "´ ¨ ¸ text", "a͏b", "  line para\u0085next\x1cfs",
    "http://a\u0085b c", "Bueno;malo:peor!mejor?", "don't can't", "a.b.c", "9.99", "..!..", "—dash–",
]


def random_texts(n, seed=7):
    rng = random.Random(seed)
    pieces = (
        sorted(lx.scored_tokens | lx.stopwords) + lx.PHRASES
        + list(".,;:!?") + ["...", "casa", "perro", "Ünïcode", "@bob", "http://t.co/a", "é", "ﬁ"]
    )
    return [
        "".join(rng.choice(pieces) + rng.choice([" ", " ", " ", "", ","]) for _ in range(rng.randint(0, 40)))
        for _ in range(n)
    ]


def check_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = tx.with_tokens(tx.with_normalized(df)).collect()
    for row in rows:
        assert row.normalized == model.normalize(row.text), repr(row.text)
        assert row.tokens == model.tokenize(row.text), repr(row.text)


def test_odd_texts(spark):
    check_texts(spark, ODD)


def test_random_texts(spark):
    check_texts(spark, random_texts(2000))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"], blacklist_characters="\x00"),
                        max_size=60), min_size=40, max_size=80))
def test_any_characters(spark, texts):
    check_texts(spark, texts)


def test_accents_of_every_character(spark):
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    rows = [("".join(chars[i : i + 97]),) for i in range(0, len(chars), 97)]
    rows = [(s, accents.fold_accents(s)) for (s,) in rows]
    df = spark.createDataFrame(rows, "s string, want string").repartition(8)
    assert df.where(accents.strip_accents(F.col("s")) != F.col("want")).count() == 0


def test_hashtags(spark):
    df = spark.createDataFrame(
        [("#Uno @dos #uno x@tres.cuatro-5 ##no #ñandu #_a ##",), ("",), (None,)], "t string"
    )
    got = [r.g for r in df.select(tx.extract_hashtags(F.col("t")).alias("g")).collect()]
    assert got == [["uno", "dos", "trescuatro5", "no", "andu", "_a"], [], None]


@pytest.mark.parametrize("n,bound", [(0, 0), (1, 0), (2, 1), (3, 3), (8, 17), (10, 25), (2048, 20481)])
def test_work_bound(spark, n, bound):
    df = spark.range(1).select(tx.work_bound(F.lit(n)).alias("b"))
    assert df.first().b == bound


def test_lexicon_sizes():
    assert len(lx.polarity_weights) == 156
    assert (len(lx.negators), len(lx.modifier_factors), len(lx.contrasts)) == (15, 27, 10)
    assert len(lx.stopwords) == 156
    assert lx.polarity_weights["gusto"] == 0.55
    assert "bien" not in lx.active_opinions and "super" not in lx.active_opinions


def test_lookups(spark):
    words = ["bueno", "super", "muy", "apenas", "jamas", "pero", lx.COMMA_TOKEN, "casa", "bien"]
    token = F.col("t")
    df = spark.createDataFrame([(w,) for w in words], "t string").select(
        "t",
        lx.polarity(token).alias("polarity"),
        lx.opinion_weight(token).alias("opinion"),
        lx.modifier_factor(token).alias("factor"),
        lx.is_negator(token).alias("negator"),
        lx.is_contrast(token).alias("contrast"),
        lx.is_clause_break(token).alias("breaks"),
    )
    got = {r.t: tuple(r)[1:] for r in df.collect()}
    assert got["bueno"] == (0.45, 0.45, None, False, False, False)
    assert got["super"] == (0.6, None, 1.35, False, False, False)
    assert got["muy"] == (None, None, 1.45, False, False, False)
    assert got["apenas"] == (None, None, 0.45, False, False, False)
    assert got["jamas"] == (None, None, None, True, False, False)
    assert got["pero"] == (None, None, None, False, True, True)
    assert got[lx.COMMA_TOKEN] == (None, None, None, False, False, True)
    assert got["casa"] == (None, None, None, False, False, False)
    assert got["bien"] == (0.42, None, None, False, False, False)
