import numpy as np

from webloom.llm.toxicity import fit, fit_ordinal, rate


def test_thresholds_are_ordered_and_weights_shared():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(2000)]
    score = np.array([2.0 * (0 in r) + 1.0 * (1 in r) for r in rows])
    grades = np.digitize(score + rng.normal(0, 0.3, 2000), [0.8, 2.4])
    weights, cuts = fit_ordinal(rows, grades, 6)
    assert cuts[0] < cuts[1]
    assert weights[0] > weights[1] > 1 and abs(weights[2:]).max() < 0.5 * weights[1]


def test_gradient_matches_the_likelihood():
    """A step along each coordinate from the optimum does not raise the likelihood."""
    rng = np.random.default_rng(1)
    rows = [np.flatnonzero(rng.random(3) < 0.5) for _ in range(300)]
    grades = np.digitize(np.array([len(r) for r in rows]) + rng.normal(0, 1.0, 300), [1.0, 2.5])
    weights, cuts = fit_ordinal(rows, grades, 3, l2=0.0, steps=3000)

    def loss(w, c):
        z = np.array([w[r].sum() for r in rows])
        upto = np.concatenate([np.zeros((300, 1)), 1 / (1 + np.exp(-(c[None] - z[:, None]))), np.ones((300, 1))], axis=1)
        return -np.log(upto[np.arange(300), grades + 1] - upto[np.arange(300), grades]).mean()

    best = loss(weights, cuts)
    for k in range(3):
        for step in (0.1, -0.1):
            assert loss(weights + step * (np.arange(3) == k), cuts) > best - 1e-4
    for k in range(2):
        for step in (0.1, -0.1):
            assert loss(weights, cuts + step * (np.arange(2) == k)) > best - 1e-4


def test_held_out_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    # Documents with an insult from the word list of the English texts are toxic for certain.
    seen = rate(d, labels.where("doc_id % 2 = 0")).join(labels.withColumnRenamed("toxic", "label"), "doc_id").where("doc_id % 2 = 1")
    counts = {(r.label, r.toxic): r["count"] for r in seen.groupBy("label", "toxic").count().collect()}
    assert counts[1, True] / (counts[1, True] + counts[1, False]) > 0.85
    assert counts.get((0, True), 0) / (counts[0, False] + counts.get((0, True), 0)) < 0.01


def test_severity_grows_with_toxic_terms_and_messy_rows_are_rated(spark, messy, rows, nothing):
    texts = [(k, f"word{k % 7} plain text number {k}" + " awful" * (k % 2) + " nasty" * (k % 4 == 1), k % 2) for k in range(400)]
    d = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(t[0], t[2]) for t in texts] + [(9999, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in rate(d, labels).collect()}
    assert got[0].expected_severity < 0.1 < 0.9 < got[3].expected_severity < got[1].expected_severity
    assert (got[0].grade, got[3].grade, got[1].grade) == (0, 1, 2)
    assert rate(messy, labels.limit(0)).where("toxic").count() == 0
    assert rate(messy, labels).count() == len(rows)
    assert rate(nothing, labels).collect() == []


def test_the_sample_is_bounded(spark):
    d = spark.range(200).selectExpr("id AS doc_id", "if(id % 2 = 1, 'bad word', 'good word') AS text")
    model = fit(d, d.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic"), sample=50)
    assert "bad" in model.weights
