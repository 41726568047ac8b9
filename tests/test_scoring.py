import random
import re
import time

import pytest
from pyspark.sql import functions as F

import model
from clamor.functions import lexicon as lx, scoring as sc, sql
from clamor.functions.scoring import with_scores
from clamor.operators import detail
from clamor.plans.fixtures import PHRASES
from test_text import ODD, random_texts

# (raw, score, class, confidence, tokens, keywords) of PHRASES, by hand.
GOLDEN = [
    (1.7925, 0.73679, "POSITIVO", 0.7061, 4, ["excellent", "helpful"]),
    (-2.12, -0.806099, "NEGATIVO", 0.9636, 7, ["awful", "delay", "rude"]),
    (-0.43, -0.222529, "NEGATIVO", 0.1694, 6, ["terrible", "great"]),
    (1.21, 0.562746, "POSITIVO", 0.4767, 4, ["rapida", "amable"]),
    (-1.18, -0.551861, "NEGATIVO", 0.4648, 4, ["bonito", "comodo"]),
    (1.065, 0.508368, "POSITIVO", 0.4195, 5, ["caro", "excelente"]),
    (0.09, 0.047333, "NEUTRAL", 0.03, 2, ["cumple"]),
    (0.0, 0.0, "NEUTRAL", 0.0, 3, []),
    (-1.86, -0.75261, "NEGATIVO", 0.7327, 5, ["lento", "odio"]),
    (0.0, 0.0, "NEUTRAL", 0.0, 0, []),
    (1.7525, 0.727016, "POSITIVO", 0.7966, 6, ["rapido", "top", "gracias"]),
    (-0.88, -0.432654, "NEGATIVO", 0.2933, 3, ["roto"]),
    (1.65, 0.700571, "POSITIVO", 0.65, 6, ["increible", "feliz"]),
    (-1.368, -0.616909, "NEGATIVO", 0.456, 3, ["malo"]),
    (0.0, 0.0, "NEUTRAL", 0.0, 0, []),
    (0.45, 0.232511, "POSITIVO", 0.15, 10, ["bueno"]),
    (-0.55, -0.28165, "NEGATIVO", 0.1833, 3, ["caro"]),
    (0.85, 0.419733, "POSITIVO", 0.2833, 3, ["excelente"]),
    (3.0, 0.918437, "POSITIVO", 1.0, 5, ["helpful", "solid", "durable", "elegante"]),
    (0.9, 0.441171, "POSITIVO", 0.3545, 2, ["bueno", "bueno"]),
]

def rule_cases():
    """Texts made from the word list, each with the class that one rule gives it."""
    sign = {True: "POSITIVO", False: "NEGATIVO"}
    strong = {w: p for w, p in lx.active_opinions.items() if abs(p) >= 0.4 and len(w) > 1}
    cases = {}
    for word, weight in strong.items():
        cases[word] = sign[weight > 0]
        cases[f"no {word}"] = sign[weight < 0]  # a negator turns what follows
        cases[f"no, {word}"] = sign[weight > 0]  # a comma ends its reach
        cases[f"{word} no"] = sign[weight > 0]  # it does not reach back
    words = sorted(strong, key=strong.get)
    for bad, good in zip(words, reversed(words[len(words) // 2 :])):
        if strong[bad] < 0 < strong[good]:
            cases[f"{good} pero {bad}"] = sign[strong[good] + 1.9 * strong[bad] > 0]
            cases[f"{bad} pero {good}"] = sign[strong[bad] + 1.9 * strong[good] > 0]
    cases["palabra otra cosa"] = "NEUTRAL"
    return cases


def scored(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(8)
    return {r.text: r for r in with_scores(df).collect()}


def test_phrases(spark):
    rows = scored(spark, [text for text, _ in PHRASES])
    for (text, _), want in zip(PHRASES, GOLDEN, strict=True):
        r = rows[text]
        assert (r.raw_score, r.score, r.sentiment, r.confidence, r.tokens, r.keywords) == want, text


def test_rules_over_the_word_list(spark):
    cases = rule_cases()
    rows = scored(spark, list(cases))
    assert len(cases) > 200
    assert {t: rows[t].sentiment for t in cases} == cases


def test_scope_words_are_no_stopwords():
    scope = lx.negators | lx.contrasts | lx.modifier_factors.keys()
    assert not [w for w in scope if w in lx.stopwords]


def test_weights_fit_their_codes():
    """The fold reads weights and factors as whole hundredths."""
    for value in [*lx.active_opinions.values(), *lx.active_modifiers.values()]:
        assert abs(100 * value - round(100 * value)) < 1e-9
        assert abs(value) < 9


def test_negation_reaches_forward_only(spark):
    rows = scored(spark, ["excelente no mala", "no mala excelente", "excelente"])
    assert rows["excelente no mala"].raw_score == pytest.approx(0.85 + 0.72)
    assert rows["no mala excelente"].raw_score == pytest.approx(0.72 - 0.85)


def test_break_resets_scope(spark):
    rows = scored(spark, ["no muy bueno", "no muy, bueno", "no muy pero bueno"])
    assert rows["no muy bueno"].raw_score == pytest.approx(-0.6525)
    assert rows["no muy, bueno"].raw_score == pytest.approx(0.45)
    assert rows["no muy pero bueno"].raw_score == pytest.approx(0.855)


def test_against_model(spark):
    texts = list(dict.fromkeys(ODD + random_texts(2000, seed=11)))
    rows = scored(spark, texts)
    for text in texts:
        got, want = rows[text], model.score(text)
        for name in ("sentiment", "tokens", "opinions", "decisions", "keywords"):
            assert got[name] == want[name], (name, text)
        assert got.score == pytest.approx(want["score"], abs=1e-6), text
        assert got.raw_score == pytest.approx(want["raw_score"], abs=1e-5, rel=1e-9), text
        assert got.confidence == pytest.approx(want["confidence"], abs=1e-4), text


def test_fold_and_clause_detail_agree(spark):
    texts = list(enumerate(random_texts(1500, seed=3)))
    df = spark.createDataFrame(texts, "i int, text string").repartition(8)
    fold = {r.i: r.raw_score for r in with_scores(df).collect()}
    detailed = {r.i: r.raw_score for r in detail.raw_scores(df, ["i"]).collect()}
    clause_sum = {
        r.i: r.s
        for r in detail.opinions(df, ["i"])
        .groupBy("i").agg(F.sum(F.col("signed_weight") * F.pow(F.lit(1.9), "depth")).alias("s"))
        .collect()
    }
    assert fold.keys() == detailed.keys()
    for i, raw in fold.items():
        assert detailed[i] == pytest.approx(raw, abs=2e-6, rel=1e-9)
        assert clause_sum.get(i, 0.0) == pytest.approx(raw, abs=2e-6, rel=1e-9)


def test_long_texts(spark):
    long_plain = "muy bueno pero " * 400 + "palabra " * 20_000 + "no excelente"
    many_contrasts = "bueno pero " * 1500 + "terrible"
    rows = scored(spark, [long_plain, many_contrasts])
    assert rows[long_plain].tokens == 3 * 400 + 20_000 + 2
    assert rows[long_plain].opinions == 401
    assert rows[many_contrasts].sentiment == "NEGATIVO"
    assert -1.0 <= rows[many_contrasts].score <= 1.0


def test_null_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, None)], "i int, text string")
    assert with_scores(df.limit(0)).count() == 0
    assert with_scores(df).first().sentiment == "NEUTRAL"


def test_partitioning_changes_nothing(spark):
    df = spark.createDataFrame(list(enumerate(random_texts(300, seed=5))), "i int, text string")
    results = [
        sorted(map(tuple, with_scores(df.repartition(n)).drop("text", "keywords").collect()))
        for n in (1, 4, 16)
    ]
    assert results[0] == results[1] == results[2]


def test_detail_of_one_long_clause(spark):
    df = spark.createDataFrame([(1, "muy " * 3 + "bueno " * 20_000)], "i int, text string")
    assert detail.opinions(df, ["i"]).count() == 20_000
    assert detail.raw_scores(df, ["i"]).first().raw_score == pytest.approx(20_000.0)


def test_scope_detail_grows_with_the_clause(spark):
    """Twice the modifiers and opinions in one clause cost about twice the time."""

    def seconds(n):
        df = spark.createDataFrame([(1, "muy bueno poco malo " * n)], "i int, text string")
        best = []
        for _ in range(2):
            begin = time.perf_counter()
            assert detail.opinions(df, ["i"]).agg(F.count("*"), F.max("factor")).first()[0] == 2 * n
            best.append(time.perf_counter() - begin)
        return min(best)

    seconds(50)
    assert seconds(8000) < 3 * seconds(4000) + 1


@pytest.mark.parametrize("n", [1, 63, 64, 65, 200])
def test_product_of_many_modifiers(spark, n):
    text = "muy bueno " * n
    df = spark.createDataFrame([(1, text)], "i int, text string")
    factor = lx.active_modifiers["muy"]
    rows = detail.opinions(df, ["i"]).orderBy("pos").collect()
    assert [r.factor for r in rows] == [pytest.approx(factor ** (k + 1), rel=1e-9) for k in range(n)]


def test_sql_functions_agree_with_the_operators(spark):
    """Odd texts, each once by SQL text and once by the operators."""
    texts = [
        None, "", "   ", "not good, never bad; but excellent!", "ﬁne ｇｏｏｄ Übel… 각 excelente",
        "no obstante sin embargo malo http://x.y/z @who", "muy muy muy bueno", "it\'s 'bad' \\ good",
        "bueno " * 300 + "pero " * 40 + "malo", "très extremadamente lento. odio no odio",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    sql.register(spark)
    df.createOrReplaceTempView("odd_texts")
    want = {r.k: r for r in with_scores(df.where("text IS NOT NULL")).collect()}
    for r in spark.sql("SELECT k, mention_score(text) s, mention_sentiment(text) c FROM odd_texts").collect():
        assert (r.s, r.c) == ((want[r.k].score, want[r.k].sentiment) if r.k in want else (None, None))
    ranked = detail.opinions_ranked(df, ["k"]).collect()
    found = spark.sql("SELECT k, o.* FROM odd_texts, LATERAL mention_opinions(text) o").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, ranked))
    rows = spark.sql("SELECT k, o.* FROM odd_texts, LATERAL mention_tokens(text) o").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, detail.token_rows(df, ["k"]).collect()))


def test_a_token_is_looked_up_among_those_of_its_length(spark):
    codes = sc._token_codes()
    maps = re.findall(r"str_to_map\('([^']*)'", sc.token_codes_sql("hits"))
    assert sum(m.count(",") + 1 for m in maps) == len(codes)
    assert max(m.count(",") + 1 for m in maps) < len(codes) / 4
    hits = [*codes, "...", "!", ",,", ";"]
    df = spark.createDataFrame([(hits,), ([],), (["zzz", "b" * 100, ""],)], "hits array<string>")
    found = [r.c for r in df.select(sc.token_codes("hits").alias("c")).collect()]
    assert found == [[*codes.values(), *[sc.BREAK_CODE] * 4], [], [None] * 3]


def folded(codes):
    """The rule of the score, one code after the other."""
    negated, factor, depth, raw = False, 1.0, 0, 0.0
    for code in codes:
        if code >= sc.BREAK_CODE:
            negated, factor = False, 1.0
            if code == sc.CONTRAST_CODE:
                depth, raw = depth + 1, raw / sc.CONTRAST_GAIN
        elif code == sc.NEGATOR_CODE:
            negated = True
        elif code >= sc.FACTOR_BASE:
            factor *= (code - sc.FACTOR_BASE) / 100.0
        else:
            raw += max(-1.0, min(1.0, (-1.0 if negated else 1.0) * (code / 100.0) * factor))
    return raw * sc.CONTRAST_GAIN**depth


def test_lists_of_any_length_are_folded_by_the_rule(spark):
    """Idle breaks are left out of long lists only; roles come in any order."""
    rng = random.Random(5)
    kinds = [sc.BREAK_CODE, sc.BREAK_CODE, sc.CONTRAST_CODE, sc.NEGATOR_CODE, 1145, 1050, 85, -72, 20]
    lists = [[rng.choice(kinds) for _ in range(n)] for n in range(2 * sc.FEW_CODES + 2) for _ in range(8)]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, codes array<int>")
    thin = df.withColumn("thin", sc.without_idle_breaks("codes"))
    for r in thin.withColumn("raw", sc.raw_score(F.col("thin"))).collect():
        assert r.raw == pytest.approx(folded(lists[r.i]), rel=1e-12, abs=1e-12)
        assert len(lists[r.i]) > sc.FEW_CODES or r.thin == lists[r.i]
