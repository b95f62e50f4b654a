import random
from collections import Counter

from pyspark.sql import functions as F

from deedweb.functions.tokens import match_text, ngrams, title_case
from deedweb.operators import match as M


def test_likeness_counts_repeated_grams(spark):
    """Both cosines against counters, over strings that repeat grams; and grams that no string repeats are not counted one by one."""
    rng = random.Random(5)
    text = lambda: "".join(rng.choice("ab1-# \t/C") for _ in range(rng.randrange(14)))
    rows = [(text(), text()) for _ in range(300)] + [("AAAA AAAA", "AAAA"), (None, "AAA"), ("AAA", None), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.where(~F.coalesce(match_text("a").eqNullSafe(F.concat(F.lit(" "), title_case(F.trim(F.substring(match_text("a"), 2, 99))), F.lit(" "))), F.lit(True))).count() == 0
    again = M._counted(F.col("a"), F.col("b"), 3, lambda s: F.size(s["again"]))
    got = df.select("a", "b", ngrams("a").alias("x"), ngrams("b").alias("y"), M.pair_similarity(F.col("a"), F.col("b")).alias("one"), M.cosine_trigram(F.col("a"), F.col("b")).alias("both"), again.alias("n"))
    for r in got.collect():
        if r.x is None or r.y is None:
            assert r.one is None and r.both == 0
            continue
        x, y = Counter(r.x), Counter(r.y)
        xy, xx, yy, own = (sum(f(k) for k in x | y) for f in (lambda k: x[k] * y[k], lambda k: x[k] ** 2, lambda k: y[k] ** 2, lambda k: y[k] ** 2 * (k in x)))
        assert r.n == sum(max(x[k], y[k]) > 1 for k in x | y)
        assert abs(r.both - (1 if r.a == r.b else xy / (xx * yy) ** 0.5 if xx * yy else 0)) < 1e-12
        c = xy / (xx * own) ** 0.5 if xx * own else 0
        want = c if r.a != r.b and 0 < c < 1 - 1e-9 else None
        assert (r.one is None) == (want is None) and (want is None or abs(r.one - want) < 1e-12)
