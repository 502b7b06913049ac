"""What jobs shuffle follows vocabularies and keys, not words times texts."""

from florilege.operators import mining, mutate, terms


def shuffled(spark, run):
    """What ``run`` returns, and the records that its stages wrote into shuffles."""

    def written():
        sc = spark.sparkContext
        none, store = sc._jvm.java.util.ArrayList(), sc._jsc.sc().statusStore()
        stages = store.stageList(none, False, False, sc._gateway.new_array(sc._jvm.double, 0), none)
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    before = written()
    out = run()
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    return out, written() - before


def test_gaps_shuffle_words_not_texts(spark):
    words = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)]
    rows = [(k % 400, " ".join(words), None, "en") for k in range(401)] + [(None, "seldom", "cz", ""), (None, "Seldom", "", None)]
    texts = spark.createDataFrame(rows, "segment_id long, content string, czech string, english string")
    lemmas = spark.createDataFrame([("wordaa", 0, "common"), ("wordab", 0, "Common2")], "surface string, candidate int, lemma string")
    run = lambda: mining.gap_lemmas(texts, lemmas, spark.createDataFrame([("wordac",)], "lemma string"), floor=1, ceiling=1.0).collect()
    out, records = shuffled(spark, run)
    # ids that repeat, the null one too, count once; so do two words of one lemma
    assert {r.lemma: r.df for r in out} == dict.fromkeys(words[3:], 400) | {"common": 400, "seldom": 1}
    assert records < 10_000


def test_resolver_shuffles_words_not_texts(spark):
    words = " ".join(f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60))
    texts = spark.createDataFrame([(k, words + " Rosa mundi", "cz", "") for k in range(400)], "segment_id long, content string, czech string, english string")
    lemmas = spark.createDataFrame([("rosa", 0, "Rosa2"), ("rosa", 1, "rosa"), ("wordaa", 0, "thing7")], "surface string, candidate int, lemma string")
    terms_ = spark.createDataFrame([(5, "Rosa")], "term_id long, lemma string")
    senses = spark.createDataFrame([(50, 5, None)], "sense_id long, term_id long, label string")
    signals = spark.createDataFrame([], "segment_id long, sense_id long, rank int")
    gaps = spark.createDataFrame([("thing", 9, 90), ("rosa", 8, 80)], "lemma string, term_id long, sense_id long")
    gone = spark.createDataFrame([(7, "ROSA")], "segment_id long, token string")
    phrases = spark.createDataFrame([(1, "no such phrase")], "phrase_id long, phrase string")
    out, records = shuffled(spark, lambda: terms.resolve_segments(texts, phrases, lemmas, terms_, senses, signals, gaps, gone).collect())
    want = [(k, 5, 50, "single", "auto") for k in range(400) if k != 7] + [(k, 9, 90, "czech_derived", "needs_review") for k in range(400)]
    assert sorted(map(tuple, out)) == sorted(want)
    assert records < 10_000


def test_upsert_shuffles_open_proposals_not_decided_ones(spark):
    row = ("CAST(id AS STRING) AS lemma", "id % 7 AS sense_id", "id AS origin", "'rendering' AS kind", "'u' AS proposed_by")
    target = spark.range(20_000).selectExpr("id AS proposal_id", *row, "IF(id % 1000 = 0, 'pending', 'rejected') AS status", "'old' AS content")
    new = spark.range(2).selectExpr("id * 1000 AS id").selectExpr("id AS proposal_id", *row, "'rejected' AS status", "'new' AS content").unionByName(
        spark.range(5, 6).selectExpr("id AS proposal_id", *row, "'rejected' AS status", "'more' AS content"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out, records = shuffled(spark, lambda: mutate.upsert_pending(target, new, "proposal_id").filter("content <> 'old'").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.proposal_id, r.status, r.content) for r in out) == [(0, "pending", "new"), (1000, "pending", "new"), (20_000, "pending", "more")]
    assert records < 10_000


def test_lift_shuffles_texts_not_words_times_texts(spark):
    words = " ".join(f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60))
    rows = [(k, words + (" rare" if k < 5 else "")) for k in range(400)]
    rows += [(7, "rare twice"), (7, "twice"), (None, "rare none"), (None, "rare"), (401, None), (402, "")]  # ids that repeat, the null one too, count once
    texts = spark.createDataFrame(rows, "segment_id long, content string")
    links = spark.createDataFrame([(1, k) for k in range(10)] + [(2, k) for k in range(5, 10)] + [(1, 3), (3, None), (None, 3)], "term_id int, segment_id long")
    run = lambda: mining.renderings(links, mining.lemma_lists(texts, "segment_id", "content")).collect()
    out, records = shuffled(spark, run)
    assert [(r.term_id, r.lemma, r.df, r.rate) for r in out] == [(1, "rare", 6, 0.6)]
    assert abs(out[0].lift - 0.6 / (1 / 390)) < 1e-9  # the null id's is the one text apart
    again = mining.renderings(links, mining.lemma_sets(texts, "segment_id", "content")).collect()
    assert again == out and mining.lemma_sets(texts, "segment_id", "content").count() == 400 * 60 + 5 + 2 + 2
    assert records < 10_000
