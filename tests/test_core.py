"""Core operators: each registered query against its SQL twin, fixtures, and behaviour that SQL can't show."""

import glob
import json
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from glyphmill.functions import clean, spelling, text
from glyphmill.operators import cascade, corpus, evaluate, lexicon, model, quotes, review, runs
from glyphmill.plans import hebrew, latin
from glyphmill.profile import HEBREW, LATIN
from glyphmill.sources import tables
from glyphmill.streaming import ingest

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = {**latin.QUERIES, **hebrew.QUERIES}, {**latin.ORACLE_SQL, **hebrew.ORACLE_SQL}


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    one = lambda v: repr(round(v, 9)) if isinstance(v, float) and not math.isnan(v) else str(v)
    return sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    twin = db.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(twin.columns)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(twin.fetchall(), twin.columns)


def _one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()[0]


def test_normalize_splits_ligatures_and_composes(spark):
    assert _one(spark, text.normalize(F.col("t")), t="ײאֵ") == "ייאֵ"


def test_identity_gate(spark):
    assert _one(spark, text.assert_identity(F.col("a"), F.col("b")), a="שלום", b="שָׁלוֹם") == "שָׁלוֹם"
    with pytest.raises(Exception, match="identity broken"):
        _one(spark, text.assert_identity(F.col("a"), F.col("b")), a="שלום", b="שָׁלוֹמ")


def test_moved_holam_can_move_on(spark):
    assert _one(spark, text.fix_mater_vowels(F.col("t")), t="בֹוו") == "בווֹ"


def test_round_trip_of_spellings(spark):
    for w in ("חִבּוּר", "כֻּלָּם", "תִּקּוּן"):
        full = _one(spark, spelling.to_male(F.col("t")), t=w)
        assert _one(spark, spelling.mechanical(F.col("t"), F.filter(spelling.mater_positions(F.col("t")), lambda p: p["pos"] == 1)), t=full) == w


def test_lenient_match_and_empty_words(spark):
    assert _one(spark, text.word_matches(F.col("a"), F.col("b"), lenient=True), a="בׇּ", b="בָ")
    assert not _one(spark, text.word_matches(F.col("a"), F.col("b")), a="בׇּ", b="בָ")
    assert _one(spark, F.size(text.words(F.lit("")))) == 0


def test_long_sentence_is_cut_behind_commas(spark):
    out = _one(spark, clean.sentences(F.col("t"), LATIN), t=", ".join(["aa bb cc"] * 25))
    assert [len(x.split()) for x in out] == [60, 15]


def test_corpus_keeps_first_and_drops_held_out(spark, tmp_path):
    rows = [(2, "b", "s", "l", "1", "ok", ["one two three.", "four five six."]), (1, "a", "s", "l", "1", "ok", ["óne two three."]), (3, "c", "s", "l", "1", "ok", ["seven eight nine."])]
    sec = spark.createDataFrame(rows, tables.SECTIONS)
    out = corpus.build_corpus(sec, spark.createDataFrame([("c",)], "ref string"), LATIN).orderBy("text").collect()
    assert [r["text"] for r in out] == ["four five six.", "óne two three."]
    path = str(tmp_path / "c")
    tables.write_corpus(corpus.build_corpus(sec, None, LATIN), path)
    assert "PartitionFilters: [" in tables.read_corpus(spark, path, ["l"])._jdf.queryExecution().toString()
    assert tables.read_artifact(spark, str(tmp_path / "none"), tables.NAMES).count() == 0


def test_lexicon_tie_goes_to_first_seen(spark):
    t = spark.createDataFrame([(1, 0, "á", "a", "<s>", False, "x"), (1, 1, "a", "a", "a", False, "x")], "doc_id long, idx int, form string, skeleton string, prev string, acronym boolean, layer string")
    lex, _ = lexicon.build(t, "doc_id", "idx", layers=("x",))
    r = lex.first()
    assert (r["best"], r["category"], r["count"]) == ("á", "ambiguous", 2)


def test_quote_does_not_cross_spans_and_drops_collisions(spark):
    src = spark.createDataFrame([(1, list("abcde"), list("abcde")), (2, list("fghi"), list("fghi")), (3, list("Abcd"), list("abcd"))], "span_id long, forms array<string>, skeletons array<string>")
    idx = quotes.index(src)
    assert {r["key"] for r in idx.collect()} == {"b c d e", "f g h i"}
    q = spark.createDataFrame([(1, list("abcdefghi"))], "id long, skeletons array<string>")
    assert [(r["start"], r["end"], r["span_id"]) for r in quotes.matches(q, idx, src).orderBy("start").collect()] == [(1, 5, 1), (5, 9, 2)]


def test_model_layer_is_checked_and_lowest(spark):
    def backend():
        class Upper:
            def vocalize_batch(self, texts):
                return [None if "bad" in t else t.replace("e", "é") for t in texts]

        return Upper()

    texts = spark.createDataFrame([(1, "he we"), (2, "bad he")], "id long, text string")
    pred = model.predict(texts, backend, LATIN)
    assert [tuple(r) for r in pred.collect()] == [(1, "hé wé")]
    d = cascade.decide(texts, cascade.Resources(model=pred), LATIN).orderBy("id", "idx").collect()
    assert [r["source"] for r in d] == ["model", "model", "unresolved", "unresolved"]
    assert model.predict(texts, model.NullBackend, LATIN).count() == 0


def test_frozen_words_withstand_overrides_in_corrections_only(spark):
    texts = spark.createDataFrame([("1", "é x")], "id string, text string")
    over = spark.createDataFrame([("*", "e", "è")], tables.OVERRIDES)
    assert cascade.decide(texts, cascade.Resources(overrides=over), LATIN).where("idx = 0").first()["source"] == "override"
    assert cascade.decide(texts, cascade.Resources(overrides=over), LATIN, freeze_first=True).where("idx = 0").first()["source"] == "preexisting"


def test_failed_texts_are_wholly_wrong(spark):
    gold = spark.createDataFrame([(1, "l", "é a"), (2, "l", "é")], "id long, layer string, text string")
    pred = spark.createDataFrame([(1, "x y"), (2, "e")], "id long, text string")
    out = {r["segment"]: r for r in evaluate.buckets(evaluate.measured(evaluate.align(gold, pred, LATIN), LATIN), {"all": F.lit(True)}).collect()}
    assert (out["overall"]["words"], out["overall"]["wrong"], out["all"]["words"]) == (3, 3, 1)


def test_review_records_last_valid_correction(spark):
    over = spark.createDataFrame([("*", "e", "é")], tables.OVERRIDES)
    fixes = spark.createDataFrame([(1, "*", "e", "è"), (2, "*", "e", "xx"), (3, "*", "a", "à")], "seq long, scope string, skeleton string, form string")
    profile = LATIN.__class__(**{**LATIN.__dict__, "strip": lambda c: F.translate(c, "éèà", "eea")})
    assert {(r["skeleton"], r["form"]) for r in review.record(over, fixes, profile).collect()} == {("e", "è"), ("a", "à")}


def test_replay_padding_and_segments(spark):
    train, replay = spark.range(10).toDF("v"), spark.range(100, 102).toDF("v")
    assert runs.with_replay(train, replay, 0.5).count() == 15
    assert _one(spark, runs.padded(F.array(F.lit(1)), F.lit(3))) == [1, -100, -100]
    segs = F.array(*[F.struct(F.lit(a).alias("source"), F.lit(b).alias("output")) for a, b in (("על ", "עַל "), ("חיבור", "חִבּוּר"), (" זה", " זֶה"))])
    assert "".join(_one(spark, runs.redistribute_segments(F.array(F.lit("על חי"), F.lit("בור זה")), segs))) == "עַל חִבּוּר זֶה"


def test_stream_equals_batch(spark, tmp_path):
    land, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    land.mkdir()
    rows = [{"section_seq": i, "ref": str(i), "source": "s", "layer": "l", "version": "1", "license": "ok", "lines": [f"one two thre{'éxyz'[i]} four.", "same words here."]} for i in range(4)]
    for part in (rows[:2], rows[2:]):
        (land / f"{part[0]['section_seq']}.jsonl").write_text("\n".join(map(json.dumps, part)))
        ingest.ingest(ingest.sections(spark, str(land)), str(out), str(ck), LATIN).awaitTermination()
    got = ingest.first_sentences(spark.read.parquet(str(out)))
    batch = corpus.build_corpus(spark.createDataFrame([tuple(r.values()) for r in rows], tables.SECTIONS), None, LATIN)
    key = lambda df: sorted((r["section_seq"], r["text"]) for r in df.collect())
    assert key(got) == key(batch)
    assert ingest.counts(got, LATIN).count() > 0


def test_sources(spark):
    v = spark.createDataFrame([("r", 0, "Other", "en", "x", ["a"]), ("r", 1, "Good Edition", "he", "", ["b"])], "ref string, idx int, title string, language string, license string, lines array<string>")
    assert tables.pick_version(v, ["good"]).first()["license"] == "unknown"
    assert _one(spark, F.lit(1)) == 1
    n = spark.createDataFrame([([["a", " "], ["b"]],)], "x array<array<string>>")
    assert n.select(tables.flatten_text("x", 2)).first()[0] == ["a", "b"]


def test_latin_strip_covers_every_decomposable_letter(spark):
    rows = spark.createDataFrame([("àÀôÔúßØæ", "aAoOußØæ"), (None, None), ("", "")], "t string, want string")
    for r in rows.select(LATIN.strip(F.col("t")).alias("got"), "want").collect():
        assert r.got == r.want


def test_tokens_neighbours_and_stray_marks(spark):
    rows = spark.createDataFrame([(1, " ְאָב בֵּן ־ ג"), (2, ""), (3, None), (4, "ד")], "id long, text string")
    got = {(r.id, r.idx): (r.form, r.skeleton, r.prev, r.next) for r in corpus.tokens(rows, HEBREW, "id").collect()}
    assert got == {(1, 0): ("אָב", "אב", "<s>", "בן"), (1, 1): ("בֵּן", "בן", "אב", "ג"), (1, 2): ("ג", "ג", "בן", None), (4, 0): ("ד", "ד", "<s>", None)}


def test_ids_beyond_one_long_fail(spark):
    from glyphmill.plans.latin import doc_tokens

    big = spark.createDataFrame([(1 << 39, "en", "a b")], "doc_id long, lang string, text string")
    with pytest.raises(Exception, match="does not fit"):
        doc_tokens(big).select("at").collect()


def test_equal_counts_go_by_first_place(spark):
    t = corpus.tokens(spark.createDataFrame([(1, "b á a b á a")], "id long, text string").withColumn("layer", F.lit("en")), LATIN, "id", "layer")
    lex, _ = lexicon.build(t.withColumn("at", F.col("idx").cast("long")), "at")
    assert [r.first for r in lex.orderBy("first").collect()] == [0, 1]


def test_sentences_keep_digits_that_equal_their_number(spark):
    assert _one(spark, clean.sentences(F.col("t"), LATIN), t="0 aa bb cc. 1 aa bb cc. Aa. 3 aa bb cc 3") == ["0 aa bb cc.", "1 aa bb cc.", "3 aa bb cc 3"]


def test_numbered_copies_are_one_sentence(spark):
    rows = spark.createDataFrame([(1, "r", "s", "l", "1", "ok", ["0 aa bb cc. 0 aa bb cc.", "1 aa bb cc. 1 aa bb cc."])], tables.SECTIONS)
    got = corpus.build_corpus(rows, None, LATIN).orderBy("line_idx").collect()
    assert [(r.line_idx, r.sent_idx, r.text) for r in got] == [(0, 0, "0 aa bb cc."), (1, 0, "1 aa bb cc.")]


def test_a_control_character_behind_a_sentence_stays(spark):
    assert _one(spark, clean.sentences(F.col("t"), LATIN), t="Aa bb cc.\u0085") == ["Aa bb cc.\u0085"]
    assert _one(spark, clean.sentences(F.col("t"), LATIN), t="aa bb cc\x01dd ee ff. Gg\x01 hh ii jj") == ["aa bb cc", "dd ee ff.", "hh ii jj"]


def test_copies_that_differ_in_any_marks_are_one(spark):
    copies = [["főd aa bb cc", "fod aa bb cc", "főd aa bb cc"], ["aa bb cc 각", "aa bb cc 각", "aa bb cc 각"], ["aa bb cc 각ᆨ"], ["aa bb cc ᄀᆨ", "aa bb cc ᄀ́ᆨ"]]
    lines = [t for c in copies for t in c]
    rows = spark.createDataFrame([(1, "r", "s", "l", "1", "ok", lines)], tables.SECTIONS)
    assert [r.text for r in corpus.build_corpus(rows, None, LATIN).orderBy("line_idx").collect()] == [c[0] for c in copies]


def test_a_section_without_a_number_comes_last(spark):
    rows = spark.createDataFrame([(n, str(n), "s", "l", "1", "ok", ["aa bb cc."]) for n in (5, None, -3)], tables.SECTIONS)
    assert [r.ref for r in corpus.build_corpus(rows, None, LATIN).collect()] == ["-3"]
