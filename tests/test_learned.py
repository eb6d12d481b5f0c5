import random

from pyspark.sql import functions as F

from stratum.operators import labels, learned

SCHEMA = ("market string, source_file string, file_row_number long, classification_text string, predicted_label string, rule_id string, "
          "manual_review_label string")
WORDS = {labels.STANDALONE: ["lemonade", "water"], labels.MEAL: ["dinner", "plate"], labels.UNCLEAR: ["surprise", "gift"]}


def rows(n=600):
    r = random.Random(4)
    out = []
    for i in range(n):
        truth = r.choice(labels.LABELS)
        text = " ".join(r.choices(["big", "small", "red", "fresh", "new"], k=4) + [r.choice(WORDS[truth])])
        rule = "meal_words" if i % 10 == 0 else labels.NO_RULE
        out.append(("USA", "f", i, text, labels.MEAL if i % 10 == 0 else labels.UNCLEAR, rule, truth if i % 4 else None))
    return out + [("USA", "f", 9000, None, labels.UNCLEAR, labels.NO_RULE, None), ("USA", "f", 9001, "big lemonade", labels.UNCLEAR, labels.NO_RULE, "no such label")]


def test_learned_labels_on_held_out_reviews(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    model = learned.fit(df.filter(~learned.is_held_out()))
    out = learned.label(df, model)
    assert out.columns == df.columns and out.count() == len(rows())
    for r in learned.metrics(out.filter(learned.is_held_out()).filter(f"rule_id = '{learned.LEARNED}'")).collect():
        assert r["reviewed"] > 20 and r["precision"] > 0.95 and r["recall"] > 0.95
    by = {r.file_row_number: r for r in out.collect()}
    assert all(by[i].rule_id == "meal_words" and by[i].predicted_label == labels.MEAL for i in range(0, 600, 10))  # rules come first
    assert by[9001].predicted_label == labels.STANDALONE
    assert learned.label(df, model, least=1.01).filter(f"rule_id = '{learned.LEARNED}'").count() == 0


def test_without_two_labels_nothing_is_learned(spark):
    df = spark.createDataFrame([r[:6] + (labels.MEAL,) for r in rows(20)], SCHEMA)
    assert learned.fit(df) is None
    assert learned.label(df, None).collect() == df.collect()


def test_texts_are_taken_apart_once_and_decided_ones_not_at_all(spark, monkeypatch):
    kept = []
    write = learned.layers.materialize
    monkeypatch.setattr(learned.layers, "materialize", lambda df, name: kept.append((name, df.columns)) or write(df, name))
    df = spark.createDataFrame(rows(), SCHEMA)
    model = learned.fit(df)
    assert kept == [("learned-features", ["target", "_features"])]
    read = []

    class Spy:
        def transform(self, df):
            read.extend(df.select("rule_id", "classification_text").collect())
            return model.transform(df)

    out = learned.label(df, Spy())
    assert {bool(r.classification_text) for r in read if r.rule_id != labels.NO_RULE} == {False}
    assert {(r.file_row_number, r.classification_text) for r in out.collect()} == {(r[2], r[3] or "") for r in rows()}


def test_metrics_score_only_held_out_reviews(spark, monkeypatch):
    from stratum.plans import queries
    scored, label = [], learned.label
    monkeypatch.setattr(learned, "label", lambda df, model: scored.append(df) or label(df, model))
    review = spark.createDataFrame(rows(), SCHEMA).withColumns({"item_name": F.col("classification_text"), "item_brand": F.lit("b1")})
    monkeypatch.setattr(queries, "_review", lambda *_: review)
    assert queries.QUERIES["label_learned_metrics"](spark, "unused").count() == 3
    assert scored[0].filter(~learned.is_held_out() | F.col("manual_review_label").isNull()).isEmpty() and not scored[0].isEmpty()
