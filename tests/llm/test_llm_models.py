import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairwright.llm import language_id, quality, toxicity, training
from pairwright.llm.subwords import ngrams

FOLDER = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def held_out_rates(found, truth):
    """Share of held-out rows of label 1, and of label 0, that are predicted 1."""
    rows = found.where("held_out").join(truth, "doc_id")
    rates = {r["truth"]: r["rate"] for r in rows.groupBy("truth").agg(F.avg("predicted").alias("rate")).collect()}
    return rates[1], rates[0]


def test_toxicity_of_held_out_documents(tables):
    docs, labels = tables
    found = toxicity.toxicity(docs, labels)
    hit, false = held_out_rates(found, labels.select("doc_id", F.col("toxic").alias("truth")))
    assert hit > 0.85 and false < 0.05


def test_quality_of_held_out_documents(tables):
    docs, labels = tables
    found = quality.quality(docs, labels)
    kept, false = held_out_rates(found, labels.select("doc_id", F.col("quality").alias("truth")))
    assert kept > 0.97 and false < 0.05


def test_language_of_held_out_documents(tables):
    docs, _ = tables
    found = language_id.language_id(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_misspellings_share_subword_vectors():
    clean = [f"the {a} river {b} stone over {a}{b} hills" for a in "abcdefghij" for b in "klmnopqrst"]
    rude = [c.replace("stone", "wretchedly") for c in clean]
    model = toxicity.fit(pa.array(clean + rude), np.array([0] * 100 + [1] * 100))
    scores = model.scores(pa.array(["the a river wretchedlly over hills", "the a river stone over hills", ""]))
    assert scores[0] > 0.5 > scores[1]


def test_ngrams_of_a_word_do_not_depend_on_its_neighbours():
    alone, _ = ngrams(pa.array(["river"]), range(3, 6))
    hashes, owner = ngrams(pa.array(["a", "", "river", "żółw"]), range(3, 6))
    assert sorted(hashes[owner == 2].tolist()) == sorted(alone.tolist())


@pytest.mark.parametrize("labelled", [[], [(4, 1, 1)], [(4, 0, 0), (6, 0, 0)], [(4, None, None), (None, 1, 1)], [(4, 1, 0), (6, 0, 1), (10, 1, 0), (10, 0, 1)]])
def test_models_on_edge_rows(spark, documents, edge_rows, labelled):
    docs = documents(rows=edge_rows)
    labels = spark.createDataFrame(labelled, LABELS)
    for found, columns in (
        (toxicity.toxicity(docs, labels), {"score", "predicted"}),
        (quality.quality(docs, labels), {"score", "predicted"}),
        (language_id.language_id(docs), {"score", "lang_pred"}),
    ):
        rows = found.collect()
        assert len(rows) == len(edge_rows) and columns <= set(found.columns)
        assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)


def test_models_on_empty_tables(spark, documents):
    labels = spark.createDataFrame([], LABELS)
    assert toxicity.toxicity(documents(), labels).count() == 0
    assert quality.quality(documents(), labels).count() == 0
    assert language_id.language_id(documents()).count() == 0


def test_texts_without_letters_are_undetermined(documents):
    rows = [(k, t, lang, "s", 0) for k, (t, lang) in enumerate(
        [("der hund und die katze", "de"), ("the dog and the cat", "en")] * 10 + [(None, "en"), ("", "en"), ("12 34 !?", "de"), ("the dog", "en"), ("der hund", None)]
    )]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.language_id(documents(rows=rows)).collect()}
    assert [got[k] for k in (20, 21, 22, 23, 24)] == ["und", "und", "und", "en", "de"]


def test_every_language_is_learned_however_many_there_are(documents):
    """150 languages with words of their own, the last one with fewer and longer texts than the others."""
    letters = "abcdefghijklmno"
    words = [f"{a}{b}{a}{b * 2}{a} {b}{a * 3}{b * 2}{a}" for a in letters for b in letters if a != b][:150]
    rows = [(150 * n + k, w, f"l{k:03d}", "s", 0) for n in range(10) for k, w in enumerate(words[:149])]
    rows += [(9000 + n, (words[149] + " ") * 20_000, "l149", "s", 0) for n in range(4)]
    found = language_id.language_id(documents(rows=rows)).select("doc_id", "lang_pred")
    got = {r["doc_id"]: r["lang_pred"] for r in found.collect()}
    assert len(got) == len(rows)
    assert [(r[0], got[r[0]]) for r in rows if got[r[0]] != r[2]] == []


def test_long_labelled_texts_are_learned_from(spark, documents):
    """Every labelled text is of some 250,000 characters; the classes still part."""
    clean = "the quiet river runs past seven old stone houses and nobody minds the slow boats. "
    rude = "the quiet wretchedly river horridscum runs!!! past ### seven $$$ old old old old. "
    rows = [(k, (rude if k % 2 else clean) * 3_050 + str(k), "en", "s", 0) for k in range(24)]
    labels = spark.createDataFrame([(k, 1 - k % 2, k % 2) for k in range(24)], LABELS)
    docs = documents(rows=rows)
    for found, good in ((toxicity.toxicity(docs, labels), 0), (quality.quality(docs, labels), 1)):
        scores = {r["doc_id"]: r["predicted"] for r in found.collect()}
        assert all(scores[k] == (good if k % 2 == 0 else 1 - good) for k in scores)


def test_long_texts_are_thinned_evenly():
    words = [f"w{k}" for k in range(60_000)]
    kept = toxicity._thin(" ".join(words)).split()
    assert len(kept) == toxicity.MOST_WINDOWS * toxicity.WINDOW
    assert kept[0] == "w0" and kept[-1] == "w59999"
    assert toxicity._thin("a  b\n c") == "a  b\n c"


def test_sampled_ids_are_the_first_by_hash(spark):
    rows = spark.range(5_000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("l"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1), (7, None)], "doc_id long, l int"))
    got = training.sample_ids(rows.repartition(5), F.col("l"), 30).collect()
    hashed = rows.where("doc_id IS NOT NULL AND l IS NOT NULL AND crc32(string(doc_id)) % 5 <> 0").selectExpr("doc_id", "l", "xxhash64(doc_id) AS h")
    want = []
    for label in (0, 1):
        want += sorted((r["h"], r["doc_id"], label) for r in hashed.collect() if r["l"] == label)[:30]
    assert sorted((r["doc_id"], r["label"]) for r in got) == sorted((d, label) for _, d, label in want)


def test_quality_parts_at_the_quantile_of_all_labelled_rows(tables):
    docs, labels = tables
    model = quality.fit_on(docs, labels, 0.3, per_class=200)
    rows = docs.join(labels, "doc_id").where("quality IS NOT NULL AND crc32(string(doc_id)) % 5 <> 0").select("text", "quality").toPandas()
    strength = model.strengths(quality.measures(pa.array(rows["text"])))
    bad = int((rows["quality"] == 0).sum())
    below = int((strength < model.parting).sum())
    assert abs(below - bad) <= 2


def test_bradley_terry_weights_minimise_the_loss():
    """Newton steps against plain gradient steps on all the same differences."""
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(60, len(quality.NAMES)))
    good = (rows[:, 0] + 0.5 * rows[:, 3] + 0.3 * rng.normal(size=60) > 0).astype(int)
    model = quality.fit(rows, good, 0.3)
    z = np.clip((rows - model.centre) / model.scale, -8, 8)
    picks = np.random.default_rng(7).choice(np.flatnonzero(good == 1), (int((good == 0).sum()), quality.RIVALS))
    diff = (z[picks] - z[good == 0][:, None, :]).reshape(-1, len(quality.NAMES))
    weights = np.zeros(diff.shape[1])
    for _ in range(20_000):
        weights -= 0.005 * (diff.T @ (1 / (1 + np.exp(-diff @ weights)) - 1) + weights)
    assert np.abs(weights - model.weights).max() < 1e-3


def test_filters_hold_what_was_put_in_and_counts_are_corrected(spark):
    """Against plain sets: nothing put in is missed, and foreign n-grams count for nothing on average."""
    rng = np.random.default_rng(5)
    grams = {name: np.unique(rng.integers(0, 2**63, 150_000).astype(np.uint64)) for name in ("aa", "bb", "cc")}
    model = language_id.fit({n: (g, np.full(len(g), 0.5)) for n, g in grams.items()})
    for k, name in enumerate(model.languages):
        held = np.bitwise_and.reduce([model.masks[at, 0] for at in language_id._positions(grams[name])])
        assert language_id._bit(held, k).all()
        foreign = rng.integers(0, 2**63, 200_000).astype(np.uint64)
        hit = language_id._bit(np.bitwise_and.reduce([model.masks[at, 0] for at in language_id._positions(foreign)]), k).mean()
        assert abs(hit - model.false_positives[k]) < 0.003
