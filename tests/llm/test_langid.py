import random

import numpy as np

from pairwright.llm import langid
from pyspark.sql import functions as F

SYLLABLES = {"xa": ["ka", "lo", "mi", "tu"], "yb": ["sch", "ein", "ung", "der"], "zc": ["ñe", "os", "ción", "que"]}


def corpus(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lang = draw.choice(list(SYLLABLES))
        words = ["".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 3))) for _ in range(draw.randint(3, 80))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_counts_equal_brute_force_across_pieces(monkeypatch):
    text = "Añb cÇ d\n" * 50
    whole = langid.gram_counts(text)
    assert whole.sum() == sum(len(text) - n for n in (0, 1, 2))
    monkeypatch.setattr(langid, "CODE_PIECE", 37)
    assert (langid.gram_counts(text) == whole).all()


def test_held_out_accuracy_and_defined_results(spark):
    rows = corpus(1, 300)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = langid.in_fold(F.col("doc_id"), 5, 0)
    model = langid.train(df.where(~held).select("text", "lang"))
    assert model.languages == sorted(SYLLABLES)
    got = {r.doc_id: r for r in langid.identify_languages(df, model).collect()}
    held_ids = [r.doc_id for r in df.where(held).collect()]
    right = sum(got[i].lang_pred == rows[i][2] for i in held_ids)
    assert held_ids and right >= 0.97 * len(held_ids)
    assert all(0 <= r.score <= 1 for r in got.values())
    odd = [(1, None), (2, ""), (3, "12 !? 34"), (4, "ungder " * 200_000), (None, "ción que"), (4, "kalomi")]
    clash = spark.createDataFrame(odd, "doc_id long, text string").selectExpr("*", "1 AS lang_pred", "2 AS found")
    found = [(r.doc_id, r.lang_pred) for r in langid.identify_languages(clash, model).collect()]
    assert found == [(1, "und"), (2, "und"), (3, "und"), (4, "yb"), (None, "zc"), (4, "xa")]
    assert langid.identify_languages(df.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([("a", None), (None, "en")], "text string, lang string")
    model = langid.train(none)
    df = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert langid.identify_languages(df, model).first().lang_pred == "und"


def test_l1_leaves_weights_at_zero_and_temperature_calibrates():
    draw = np.random.default_rng(1)
    rows = [(np.array([k, 50 + k, langid.BUCKETS]), np.array([1.0, draw.uniform(0, 1e-7), 1.0])) for k in (0, 1) * 60]
    weights, bias = langid.ftrl(rows, np.array([0, 1] * 60), 2)
    assert weights[0, 0] > weights[0, 1] and (weights[50:] == 0).all()
    logits = draw.normal(0, 1, (4000, 2))
    y = (draw.random(4000) < langid.softmax(logits)[:, 1]).astype(int)
    assert abs(langid.temperature_of(logits * 5, y) - 5) < 1


def test_languages_of_long_texts_only_are_learnt(spark):
    rows = [(f"{i} " + "kalo mitu " * (6_000 + i), "xa") for i in range(12)]
    rows += [(f"{i} " + "sch ein ung " * (6_000 + i), "yb") for i in range(12)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert [model.predict(t)[0] for t in ("kalo mitu kalo", "ungein sch der")] == ["xa", "yb"]


def test_copies_do_not_fill_the_sample(spark, monkeypatch):
    rows = [(t, lang) for _, t, lang in corpus(3, 90)] + [("kalomi", "xa")] * 500
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    languages, sample = langid.fit_rows(df, 30)
    assert [sum(r.lang == lang for r in sample) for lang in languages] == [10, 10, 10]
    assert len({(r.hit, r.times) for r in sample}) == 30
    monkeypatch.setattr(langid, "FIT_ENTRIES", 3)  # room for none: the first row of each stays
    assert sorted(r.lang for r in langid.fit_rows(df, 30)[1]) == languages


def test_training_unpacks_one_row_at_a_time(monkeypatch):
    """All rows lie in the driver's memory: a row's weights, twice its packed counts, are made when it is looked at."""
    import tracemalloc
    from types import SimpleNamespace

    draw = np.random.default_rng(5)
    hits = [np.sort(draw.choice(langid.BUCKETS, 5000, replace=False)) for _ in range(400)]
    packed = [
        SimpleNamespace(lang="ab"[i % 2], hit=h.astype("<u2").tobytes(), times=np.full(5000, 1 + i, "<u4").tobytes())
        for i, h in enumerate(hits)
    ]

    class Frame:
        def __getattr__(self, name):
            return lambda *a, **b: [] if name == "collect" else self

    frame = Frame()
    frame.sparkSession = None
    monkeypatch.setattr(langid, "fit_rows", lambda df, rows: (["a", "b"], packed))
    monkeypatch.setattr(langid.F, "sum", lambda c: frame)
    tracemalloc.start()
    model = langid.train(frame)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # the weights of the model and their gradients take 8 MB, all rows unpacked 24 MB and more
    assert model.languages == ["a", "b"] and model.weights.any() and most < 16e6
