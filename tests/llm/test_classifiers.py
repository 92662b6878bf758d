"""Language id, quality and toxicity: held-out accuracy and edge cases."""

import random

import pytest

from cinelens.llm import langid, nbsvm, quality, queries, toxicity

from .fixtures import awkward, docs, words

STOCK = {"en": "the and with from house street water morning people never", "de": "und der nicht haus straße wasser morgen leute niemals über",
         "es": "que los calle agua mañana gente nunca siempre ñandú corazón"}


def labelled(spark, n=240):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = words(i, rng.randint(20, 80))
        if bad:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["zonkhead", "grubface"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, label int")


@pytest.mark.parametrize("params", [nbsvm.Params(bits=16), nbsvm.Params(grams="word", bits=16, smoothing=5.0)])
def test_nbsvm_held_out(spark, params):
    d, l = labelled(spark)
    model = nbsvm.fit(d.filter("doc_id % 4 > 0"), l, params)
    got = {r["doc_id"]: r["score"] for r in nbsvm.score(d.filter("doc_id % 4 = 0"), model).collect()}
    assert len(got) == 60 and all((s >= 0.5) == (i % 3 == 0) for i, s in got.items())


def test_nbsvm_awkward_rows_and_no_labels(spark):
    d, l = labelled(spark)
    model = nbsvm.fit(d, l.union(spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, label int")), nbsvm.Params(bits=14))
    odd = docs(spark, awkward())
    got = nbsvm.score(odd, model).collect()
    assert len(got) == len(awkward()) and all(0 <= r["score"] <= 1 for r in got)
    assert nbsvm.score(odd.limit(0), model).count() == 0
    flat = nbsvm.fit(d, l.filter("label = 0"), nbsvm.Params(bits=14))
    assert {r["score"] for r in nbsvm.score(odd, flat).collect()} == {0.5}
    kept = toxicity.remove(odd, model)
    assert kept.columns == odd.columns and kept.filter("text is null or text = ''").count() == 2
    assert quality.PARAMS.fit_rows and toxicity.remove(odd.limit(0), model).count() == 0


def language_rows():
    rng = random.Random(5)
    out = []
    for i in range(150):
        lang = list(STOCK)[i % 3]
        out.append((i, "\n".join(" ".join(rng.choices(STOCK[lang].split(), k=rng.randint(3, 12))) for _ in range(4)), lang))
    return out


def test_language_held_out_and_awkward(spark):
    d = docs(spark, language_rows())
    learned = langid.learn(d.filter("doc_id % 5 > 0"))
    assert sorted(learned) == ["de", "en", "es"] and max(map(len, learned.values())) <= langid.Params().dict_bytes
    got = langid.identify(d.filter("doc_id % 5 = 0"), learned).collect()
    assert sum(r["lang_best"] == list(STOCK)[r["doc_id"] % 3] for r in got) >= 0.95 * len(got)
    odd = langid.identify(docs(spark, awkward() + [(20, "123 456")]), learned).collect()
    assert len(odd) == len(awkward()) + 1
    for r in odd:
        assert 0 <= r["score"] <= 1
        assert (r["lang_best"] == "und") == (r["doc_id"] in (1, 2, 3, 5, 20))
    assert langid.identify(d.limit(0), learned).count() == 0


def test_language_narrow_margin_and_nothing_learned(spark):
    d = docs(spark, [(1, "mañana und street")])
    learned = langid.learn(docs(spark, language_rows()))
    r = langid.identify(d, learned, langid.Params(min_margin=0.99)).first()
    assert r["lang"] == "und" and r["lang_best"] in STOCK
    none = langid.learn(docs(spark, [(1, "text"), (2, None, "en")]))
    assert none == {} and langid.identify(d, none).first()["lang_best"] == "und"


@pytest.mark.parametrize("name", ["op1_language_id", "op5_quality", "op10_toxicity"])
def test_queries_cover_all_documents(spark, name):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES[name](spark, sf).toPandas()
    docs_ = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    assert sorted(got.doc_id) == sorted(docs_.doc_id) and got.score.between(0, 1).all()
    if name.startswith("op1_"):
        both = got.merge(docs_, on="doc_id")
        held = both[both.held_out]
        assert (held.lang_pred == held.lang).mean() > 0.9
    else:
        assert (got.predicted == (got.score >= 0.5)).all()


def test_fits_are_not_cut():
    from cinelens.llm import quality, toxicity

    assert quality.PARAMS.fit_rows == toxicity.PARAMS.fit_rows == 3000


def test_language_of_few_long_lines(spark):
    """Every language has a full dictionary, however long its lines are."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(STOCK[lang].split(), k=20_000)), lang) for i, lang in enumerate(list(STOCK) * 4)]
    learned = langid.learn(docs(spark, rows))
    p = langid.Params()
    assert sorted(learned) == sorted(STOCK) and all(len(x) > 0.9 * p.dict_bytes for x in learned.values())


def test_language_sizes_equal_plain_compression():
    """The language is that of the smallest output of zstandard itself."""
    import zstandard as zs

    rng, p = random.Random(7), langid.Params()
    learned = {k: langid.letters(" ".join(rng.choices(v.split(), k=3000))) for k, v in STOCK.items()}
    model = langid.Compressors(learned, p)
    setting = zs.ZstdCompressionParameters.from_level(6, min_match=4, search_log=4, strategy=zs.STRATEGY_GREEDY, window_log=20,
                                                      write_content_size=False, write_checksum=False, write_dict_id=False)
    for lang, stock in STOCK.items():
        text = " ".join(rng.choices(stock.split(), k=600))
        raw = langid.letters(text)
        sizes = {}
        for k, d in learned.items():
            one = zs.ZstdCompressor(compression_params=setting, dict_data=zs.ZstdCompressionDict(d, dict_type=zs.DICT_TYPE_RAWCONTENT))
            sizes[k] = sum(len(one.compress(raw[i : i + p.window])) for i in range(0, len(raw), p.window))
        assert model.sizes(raw).tolist() == list(sizes.values())
        assert model(text)[0] == min(sizes, key=sizes.get) == lang


def plain_fit(texts, labels, p):
    """Ratios and the optimum of the hinge loss with plain NumPy: features as
    sets, dense rows, projected gradient on the dual to convergence."""
    import numpy as np

    features = nbsvm.Features(p)
    rows = [sorted(set(features(t).tolist())) for t in texts]
    y = np.where(np.array(labels) > 0, 1.0, -1.0)
    vocab = sorted({g for r in rows for g in r})
    at = {g: i for i, g in enumerate(vocab)}
    x = np.zeros((len(rows), len(vocab)))
    for i, r in enumerate(rows):
        x[i, [at[g] for g in r]] = 1
    neg, pos = x[y < 0].sum(axis=0), x[y > 0].sum(axis=0)
    share = pos.sum() / (pos.sum() + neg.sum())
    a = p.smoothing
    ratio = np.log((pos + 2 * a * share) / share) - np.log((neg + 2 * a * (1 - share)) / (1 - share))
    z = x * ratio
    z = np.hstack([z / np.linalg.norm(z, axis=1, keepdims=True), np.ones((len(z), 1))]) * y[:, None]
    top = p.cost * np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    q, alpha = z @ z.T, np.zeros(len(y))
    for _ in range(20_000):
        alpha = np.clip(alpha - (q @ alpha - 1) / np.linalg.norm(q, 2), 0, top)
    loss = lambda w: 0.5 * w @ w + (top * np.maximum(0, 1 - z @ w)).sum()
    return dict(zip(vocab, ratio)), loss, z.T @ alpha, at


@pytest.mark.parametrize("params", [nbsvm.Params(bits=16, epochs=200), nbsvm.Params(grams="word", bits=16, smoothing=5.0, epochs=200)])
def test_fit_equals_plain_solver(spark, params):
    import numpy as np

    rng = random.Random(11)
    texts, labels = [], []
    for i in range(60):
        text = words(i, rng.randint(10, 40))
        if i % 3 == 0 and i % 9:
            text.insert(3, "zonkhead")
        texts.append(" ".join(text) + " é日本")
        labels.append(int(i % 3 == 0))
    d = docs(spark, list(enumerate(texts)))
    model = nbsvm.fit(d, spark.createDataFrame(list(enumerate(labels)), "doc_id long, label int"), params)
    ratio, loss, best, at = plain_fit(texts, labels, params)
    assert all(abs(model.square[g] - r * r) <= 1e-5 * (1 + r * r) for g, r in ratio.items())
    # Weights of indicators are ratio times the fitted weight.
    w = np.append([model.weight[g] / r if r else 0.0 for g, r in ratio.items()], model.bias)
    assert loss(best) <= loss(w) + 1e-6 and loss(w) <= loss(best) * 1.01 + 1e-3


def test_character_grams_are_of_characters():
    from cinelens.llm import kernels

    for text in ("абвгд", "天地玄黄宇宙", "a\U0001F600bcdefg"):
        padded = f" {text.lower()} "
        for n in (5, 6, 7):
            got = kernels.char_ngrams(text, (n,), 24)
            assert len(got) == max(len(padded) - n + 1, 0) == len(set(got.tolist()))


def test_documents_labelled_several_times(spark):
    """Each label row counts; a document with both labels is in both classes."""
    d, l = labelled(spark, 60)
    twice = nbsvm.fit(d, l.union(l), nbsvm.Params(bits=14))
    both = nbsvm.fit(d, l.union(l.filter("doc_id = 0").selectExpr("doc_id", "1 - label")), nbsvm.Params(bits=14))
    for model in (twice, both):
        got = {r["doc_id"]: r["score"] for r in nbsvm.score(d, model).collect()}
        assert sum((got[i] >= 0.5) == (i % 3 == 0) for i in got) >= 58


def test_ratios_reach_the_driver_packed(spark, monkeypatch):
    """A row for each n-gram would be half a million objects on the driver."""
    d, l = labelled(spark)
    params, most = nbsvm.Params(bits=14), []
    collect = type(d).collect

    def counted(self):
        most.append(collect(self))
        return most[-1]

    def refused(self):
        raise AssertionError("n-grams collected row by row")

    monkeypatch.setattr(type(d), "collect", counted)
    monkeypatch.setattr(type(d), "toPandas", refused)
    model = nbsvm.fit(d, l, params)
    assert (model.square > 0).sum() > 1000 and max(map(len, most)) < 100
