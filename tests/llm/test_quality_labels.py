from pulsetrail.llm import quality


def test_all_labels_certify(spark, monkeypatch):
    """1,200 labelled good documents certify a rule; a sample of them would not."""
    monkeypatch.setattr(quality, "LABELLED", 100, raising=False)      # the bound on labels that was
    word = "concat_ws(' ', transform(sequence(1, 20), k -> concat('word', id, 'x', k{})))"
    docs = spark.range(1400).selectExpr(
        "id AS doc_id", f"CASE WHEN id < 1200 THEN {word.format('')} ELSE {word.format(", '####'")} END AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id < 1200 AS INT) AS quality")
    got = {r["doc_id"]: r["rejected_by"] for r in quality.report(docs, labels).collect()}
    assert all(got[i] == "" for i in range(1200)) and all("symbol_rate" in got[i] for i in range(1200, 1400))
