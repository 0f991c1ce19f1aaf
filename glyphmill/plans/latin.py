"""Registered queries of the core operators over the tables documents, benchmark, labels, pages, conversations, with SQL twins.

Documents stand for sections (a line of text is a line, lang the layer, source the licence), labels for the held-out set,
benchmark for the quotable source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, clean, text
from ..operators import cascade, corpus, evaluate, lexicon, quotes, review, runs
from ..profile import LATIN
from ..sources import store, tables

MARKERS = ["the", "of", "and", "that", "les", "des"]
TRIGGERS = ["the", "der", "el", "le"]
LAYERS = ("en", "fr")
QUOTA = 40

HOMOGRAPHS = [("re", '{"after": {"le": "ré"}, "before": {"the": "re"}, "default": "ré"}'), ("ea", '"éa"'), ("en", '{"after": {"the": "èn"}}')]
OVERRIDES = [("*", "er", "ér"), ("*", "on", "onx"), ("12", "er", "er"), ("28", "in", "ín"), ("*", "st", "")]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/{name}.parquet")
    return store.spread(rows, "doc_id") if name == "documents" else rows


def sections(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    return docs.select(F.col("doc_id").alias("section_seq"), F.col("doc_id").cast("string").alias("ref"), "source", F.col("lang").alias("layer"), F.lit("1").alias("version"), F.concat(F.lit("CC-BY"), F.when(F.col("lang") == "fr", "-NC").otherwise("")).alias("license"), F.split("text", "\n").alias("lines"))


def held_out(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "labels").select("doc_id").distinct()


def doc_tokens(docs: DataFrame) -> DataFrame:
    """Tokens with `at`, the document's id and the word's number in one long. Ids beyond 2^39 and texts beyond 2^24 words fail; lexicon operators take (doc_id, idx) as their place for those."""
    t = corpus.tokens(docs.withColumn("layer", F.col("lang")), LATIN, "doc_id", "layer")
    fits = F.col("doc_id").between(-(1 << 39), (1 << 39) - 1) & (F.col("idx") < 1 << 24)
    return t.withColumn("at", F.when(fits, F.shiftleft("doc_id", 24) + F.col("idx")).otherwise(F.raise_error(F.lit("an id or a word's number does not fit into one long")).cast("long")))


PLACE = ("at",)
W = "[A-Za-zÀ-ÖØ-öø-ÿ]+"


def tok_sql(source: str, name: str = "tok") -> str:
    return f"""{name}_w as (select doc_id, lang, list_filter(regexp_extract_all(text, '{W}'), lambda z: z <> '') as w from {source}),
{name} as (select doc_id, lang as layer, idx, form, strip_accents(form) as skeleton,
  coalesce(lag(strip_accents(form)) over (partition by doc_id order by idx), '<s>') as prev,
  lead(strip_accents(form)) over (partition by doc_id order by idx) as next
  from (select doc_id, lang, unnest(w) as form, generate_subscripts(w, 1) - 1 as idx from {name}_w))"""


def lexicon_sql(tok: str = "tok") -> str:
    return f"""counts as (select skeleton, form, count(*) as n, min(struct_pack(doc_id := doc_id, idx := idx)) as first from {tok} group by all),
pairs as (select prev, skeleton, form, count(*) as n, min(struct_pack(doc_id := doc_id, idx := idx)) as first from {tok} group by all),
decided as (select prev, skeleton, arg_min(form, struct_pack(k := -n, first := first)) as form from pairs group by prev, skeleton having sum(n) >= 2 and max(n) / sum(n) >= 0.80),
resolvable as (select distinct skeleton from decided),
by_skeleton as (select skeleton, sum(n)::bigint as count, min(first) as seen, max(n) as most, arg_min(form, struct_pack(k := -n, first := first)) as best from counts group by skeleton),
entries as (select skeleton, case when most / count >= 0.98 and count >= 3 then 'unambiguous' when r.skeleton is not null then 'context' else 'ambiguous' end as category, best, count, most, seen
  from by_skeleton left join resolvable r using (skeleton)),
inside as (select skeleton, form, count(*) as n, min(struct_pack(doc_id := doc_id, idx := idx)) as first from {tok} where layer in ('en', 'fr') group by all),
preferred as (select i.skeleton, i.form as rabbinic from (select skeleton, arg_min(form, struct_pack(k := -n, first := first)) as form from inside group by skeleton having sum(n) >= 3 and max(n) / sum(n) >= 0.98) i join entries e using (skeleton) where i.form <> e.best),
bigrams as (select prev, skeleton, form from decided join entries using (skeleton) where category <> 'unambiguous')"""


TOK = "with " + tok_sql("documents")
TRAIN = "train as (select * from documents where doc_id not in (select doc_id from labels)), test as (select * from documents where doc_id in (select doc_id from labels))"


# --- text -----------------------------------------------------------------


def strip_marks(spark, d):  # noqa: ANN001, ANN201
    return _table(spark, d, "documents").select("doc_id", F.md5(LATIN.strip(F.col("text")).cast("binary")).alias("skeleton_md5"))


def tokens(spark, d):  # noqa: ANN001, ANN201
    return doc_tokens(_table(spark, d, "documents")).select("doc_id", "idx", "form", "skeleton", "prev", "next")


def segments_lossless(spark, d):  # noqa: ANN001, ANN201
    seg = text.segments(F.col("text"), LATIN)
    rows = _table(spark, d, "documents").select("doc_id", "text", seg.alias("s"))
    return rows.select("doc_id", F.size("s").cast("long").alias("n_segments"), F.size(F.filter("s", lambda x: x["is_word"])).cast("long").alias("n_words"), (F.array_join(F.transform("s", lambda x: x["piece"]), "") == F.col("text")).alias("lossless"))


def mark_flags(spark, d):  # noqa: ANN001, ANN201
    t = F.col("text")
    marked = F.length(F.regexp_replace(t, "[^éóèñçüêäöíÉÈÑÓÇÄÊÜÖÍ]", "")).cast("long")
    letters = F.length(F.regexp_replace(t, f"[^{LATIN.letter[1:-1]}]", "")).cast("long")
    return _table(spark, d, "documents").select("doc_id", text.has_marks(t, LATIN).alias("has_marks"), text.has_letters(t, LATIN).alias("has_letters"), marked.alias("n_marked"), letters.alias("n_letters"))


def identity_diffs(spark, d):  # noqa: ANN001, ANN201
    t = F.col("text")
    diff = text.identity_diff(t, LATIN.strip(t))
    return _table(spark, d, "benchmark").select("item_id", diff["at"].cast("long").alias("at"), diff["a"].alias("a"), diff["b"].alias("b"))


def clean_pages(spark, d):  # noqa: ANN001, ANN201
    return _table(spark, d, "pages").select("page_id", F.md5(clean.clean_line(F.col("html")).cast("binary")).alias("cleaned_md5"), F.length(clean.clean_line(F.col("html"))).cast("long").alias("n"))


def _clean_sql(c: str, latin: bool) -> str:
    for pattern, by in (("<[^>]{0,200}>", " "), (r"\{[^}]{0,200}\}", " "), (r"\[[^\]]{0,4}\]", " "), ("[*†‡°]", "")) + ((("[A-Za-z]{2,}", " "),) if latin else ()):
        c = f"regexp_replace({c}, '{pattern}', '{by}', 'g')"
    return f"trim(regexp_replace(translate({c}, '[]{{}}', ''), '[\\s\\x0b\\p{{Z}}]+', ' ', 'g'))"


SENTENCES = f"""with lines as (select doc_id, source, lang, unnest(l) as line, generate_subscripts(l, 1) - 1 as line_idx from (select *, string_split(text, chr(10)) as l from documents)),
cleaned as (select doc_id, source, lang, line_idx, {_clean_sql("line", False)} as line from lines),
chunked as (select *, list_filter(list_transform(string_split(regexp_replace(line, '([\\x{{05C3}}.?!])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda z: trim(z)), lambda z: len(regexp_extract_all(z, '{W}')) >= 3) as c from cleaned),
chunks as (select doc_id, source, lang, line_idx, unnest(c) as chunk, generate_subscripts(c, 1) as k from chunked),
folded as (select *, case when len(regexp_extract_all(chunk, '{W}')) <= 60 then {{'out': [chunk], 'buf': []::varchar[], 'n': 0::bigint, 'p': ''}} else
  list_reduce(list_prepend({{'out': []::varchar[], 'buf': []::varchar[], 'n': 0::bigint, 'p': ''}}, list_transform(string_split(regexp_replace(chunk, ',\\s+', ',' || chr(1), 'g'), chr(1)), lambda z: {{'out': []::varchar[], 'buf': []::varchar[], 'n': 0::bigint, 'p': z}})),
    lambda a, b: case when a.n + len(regexp_extract_all(b.p, '{W}')) >= 60 then {{'out': list_append(a.out, trim(array_to_string(list_append(a.buf, b.p), ' '))), 'buf': []::varchar[], 'n': 0::bigint, 'p': ''}}
      else {{'out': a.out, 'buf': list_append(a.buf, b.p), 'n': a.n + len(regexp_extract_all(b.p, '{W}')), 'p': ''}} end) end as f from chunks),
cut as (select doc_id, source, lang, line_idx, k, case when len(f.buf) > 0 and f.n >= 3 then list_append(f.out, trim(array_to_string(f.buf, ' '))) else f.out end as o from folded),
parts as (select doc_id, source, lang, line_idx, k, unnest(o) as text, generate_subscripts(o, 1) as j from cut),
sents as (select doc_id, source, lang, line_idx, row_number() over (partition by doc_id, line_idx order by k, j) - 1 as sent_idx, text, len(regexp_extract_all(text, '{W}')) as n_words from parts)"""


def sentences(spark, d):  # noqa: ANN001, ANN201
    s = corpus.sentences(sections(spark, d), LATIN)
    return s.select(F.col("section_seq").alias("doc_id"), F.col("line_idx").cast("long").alias("line_idx"), F.col("sent_idx").cast("long").alias("sent_idx"), "text", F.col("n_words").cast("long").alias("n_words"))


def dedup_sentences(spark, d):  # noqa: ANN001, ANN201
    s = corpus.build_corpus(sections(spark, d), None, LATIN)
    return s.select(F.col("section_seq").alias("doc_id"), F.col("line_idx").cast("long").alias("line_idx"), F.col("sent_idx").cast("long").alias("sent_idx"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


DEDUP = "first as (select arg_min(struct_pack(doc_id := doc_id, source := source, lang := lang, line_idx := line_idx, sent_idx := sent_idx, text := text, n_words := n_words), struct_pack(a := doc_id, b := line_idx, c := sent_idx)) as r from sents group by strip_accents(text))"


def corpus_summary(spark, d):  # noqa: ANN001, ANN201
    s = corpus.build_corpus(sections(spark, d), held_out(spark, d).select(F.col("doc_id").cast("string").alias("ref")), LATIN, commercial_only=True)
    return corpus.statistics(s)


def eval_sample(spark, d):  # noqa: ANN001, ANN201
    s = corpus.sample_eval(corpus.deduplicate(corpus.sentences(sections(spark, d), LATIN), LATIN), QUOTA)
    return s.select("id", "source", F.col("n_words").cast("long").alias("n_words"))


def eval_manifest(spark, d):  # noqa: ANN001, ANN201
    s = corpus.sample_eval(corpus.deduplicate(corpus.sentences(sections(spark, d), LATIN), LATIN), QUOTA)
    return s.groupBy("source").agg(F.count(F.lit(1)).alias("sentences"), F.sum("n_words").alias("words"), F.count_distinct("ref").alias("refs"))


SAMPLE = f"""{SENTENCES}, {DEDUP}, kept as (select unnest(r) from first), sizes as (select source, doc_id, count(*) as n from kept group by all),
starts as (select source, doc_id, coalesce(sum(n) over (partition by source order by md5('20260916:' || doc_id::varchar), doc_id::varchar rows between unbounded preceding and 1 preceding), 0) as before from sizes),
picked as (select kept.*, before, row_number() over (partition by source, doc_id order by line_idx, sent_idx) as k from kept join starts using (source, doc_id) where before < {QUOTA}),
sample as (select *, doc_id::varchar || '#' || k as id from picked where before + k <= {QUOTA})"""


def marker_layers(spark, d):  # noqa: ANN001, ANN201
    w = F.transform(text.words(F.col("text"), LATIN), F.lower)
    share = classify.marker_share(w, MARKERS)
    return _table(spark, d, "documents").select("doc_id", share.alias("share"), F.when(share >= 0.08, "marked").otherwise(F.col("lang")).alias("layer"))


def license_verdicts(spark, d):  # noqa: ANN001, ANN201
    return tables.license_log(sections(spark, d)).select("source", "version", "sections", "license", "verdict", "example_ref")


def heldout_antijoin(spark, d):  # noqa: ANN001, ANN201
    return corpus.drop_held_out(_table(spark, d, "documents"), held_out(spark, d), "doc_id").select("doc_id", "lang")


def leakage_guard(spark, d):  # noqa: ANN001, ANN201
    docs = _table(spark, d, "documents")
    test = docs.join(held_out(spark, d), "doc_id", "left_semi")
    train = docs.join(held_out(spark, d), "doc_id", "left_anti")
    return corpus.leaks(train, test, LATIN).select("doc_id", "source")


def content_hash(spark, d):  # noqa: ANN001, ANN201
    return tables.content_hash(_table(spark, d, "benchmark"), "item_id", "text")


# --- lexicon --------------------------------------------------------------


def lexicon_forms(spark, d):  # noqa: ANN001, ANN201
    c = lexicon.form_counts(doc_tokens(_table(spark, d, "documents")), *PLACE)
    return c.select("skeleton", "form", "n", F.shiftright("first", 24).alias("first_doc"), F.col("first").bitwiseAND((1 << 24) - 1).alias("first_idx"))


def _built(spark, d):  # noqa: ANN001, ANN202
    pairs = store.stored(lexicon.pair_counts(doc_tokens(_table(spark, d, "documents")), *PLACE, layers=LAYERS))
    counts = lexicon.counts_of(pairs)
    return counts, lexicon.entries(counts, lexicon.decisions_of(pairs))


def lexicon_entries(spark, d):  # noqa: ANN001, ANN201
    return _built(spark, d)[1].select("skeleton", "category", "best", "count", "ratio")


def lexicon_variants(spark, d):  # noqa: ANN001, ANN201
    return _built(spark, d)[1].select("skeleton", F.posexplode("variants").alias("place", "v")).select("skeleton", F.col("place").cast("long").alias("place"), "v.form", "v.n")


def bigram_table(spark, d):  # noqa: ANN001, ANN201
    return lexicon.build(doc_tokens(_table(spark, d, "documents")), *PLACE, layers=LAYERS)[1]


def preferred_forms(spark, d):  # noqa: ANN001, ANN201
    return lexicon.preferred_of(*_built(spark, d))


def names(spark, d):  # noqa: ANN001, ANN201
    return lexicon.names(doc_tokens(_table(spark, d, "documents")), TRIGGERS)


def review_queue(spark, d):  # noqa: ANN001, ANN201
    q = lexicon.review_queue(_built(spark, d)[1])
    return q.select("skeleton", "count", F.size("variants").cast("long").alias("n_variants"))


def layer_sizes(spark, d):  # noqa: ANN001, ANN201
    return lexicon.layer_sizes(doc_tokens(_table(spark, d, "documents")))


# --- quotes ---------------------------------------------------------------


def _quotes(spark, d):  # noqa: ANN001, ANN202
    low = F.transform(text.words(F.col("text"), LATIN), F.lower)
    source = quotes.spans(_table(spark, d, "benchmark"), low, F.transform(low, LATIN.strip), "item_id")
    queries = _table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.transform(low, LATIN.strip).alias("skeletons"))
    return queries, source


def quote_index(spark, d):  # noqa: ANN001, ANN201
    return quotes.index(_quotes(spark, d)[1]).select("key", "span_id", F.col("off").cast("long").alias("off"))


def quote_collisions(spark, d):  # noqa: ANN001, ANN201
    low = F.transform(text.words(F.col("text"), LATIN), F.lower)
    source = quotes.spans(_table(spark, d, "documents"), low, F.transform(low, LATIN.strip), "doc_id")
    return quotes.collisions(source)


def quote_hits(spark, d):  # noqa: ANN001, ANN201
    q, s = _quotes(spark, d)
    return quotes.hits(q, quotes.index(s)).select("id", F.col("i").cast("long").alias("i"), "span_id", F.col("off").cast("long").alias("off"))


def quote_matches(spark, d):  # noqa: ANN001, ANN201
    q, s = _quotes(spark, d)
    return quotes.matches(q, quotes.index(s), s).select("id", *(F.col(c).cast("long").alias(c) for c in ("start", "end", "span_id", "off")))


QUOTES = f"""src as (select item_id as span_id, list_transform(regexp_extract_all(text, '{W}'), lambda z: lower(z)) as f from benchmark),
qry as (select doc_id as id, list_transform(regexp_extract_all(text, '{W}'), lambda z: strip_accents(lower(z))) as s from documents),
sg as (select span_id, o as off, array_to_string(list_transform(f[o + 1 : o + 4], lambda z: strip_accents(z)), ' ') as key, array_to_string(f[o + 1 : o + 4], ' ') as ff from src, lateral (select unnest(range(len(f) - 3)) as o) where len(f) >= 4),
idx as (select key, arg_min(span_id, struct_pack(a := span_id, b := off)) as span_id, arg_min(off, struct_pack(a := span_id, b := off)) as off from sg group by key having count(distinct ff) = 1),
qg as (select id, i, array_to_string(s[i + 1 : i + 4], ' ') as key from qry, lateral (select unnest(range(len(s) - 3)) as i) where len(s) >= 4),
hits as (select id, i, span_id, off from qg join idx using (key))"""


# --- cascade and evaluation -----------------------------------------------


def _rules(spark):  # noqa: ANN001, ANN202
    return tables.parse_homographs(spark.createDataFrame(HOMOGRAPHS, "skeleton string, json string"))


def _overrides(spark):  # noqa: ANN001, ANN202
    return spark.createDataFrame(OVERRIDES, tables.OVERRIDES)


def _decisions(spark, d):  # noqa: ANN001, ANN202
    docs = _table(spark, d, "documents")
    train = docs.join(held_out(spark, d), "doc_id", "left_anti")
    test = docs.join(held_out(spark, d), "doc_id", "left_semi")
    lex, bigrams = lexicon.build(doc_tokens(train), *PLACE, layers=LAYERS)
    plain = test.select(F.col("doc_id").alias("id"), LATIN.strip(F.col("text")).alias("text"))
    decided = cascade.decide(plain, cascade.Resources(lex, bigrams, _rules(spark), _overrides(spark)), LATIN, scope=F.col("id").cast("string"))
    return test, plain, decided


def cascade_decisions(spark, d):  # noqa: ANN001, ANN201
    return _decisions(spark, d)[2].select("id", F.col("idx").cast("long").alias("idx"), "skeleton", "form", "source", "confident", "note")


def cascade_by_source(spark, d):  # noqa: ANN001, ANN201
    return cascade.by_source(_decisions(spark, d)[2])


def cascade_text(spark, d):  # noqa: ANN001, ANN201
    _, plain, decided = _decisions(spark, d)
    out = cascade.reassemble(plain, decided, LATIN)
    return out.select("id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def identity_check(spark, d):  # noqa: ANN001, ANN201
    test, plain, decided = _decisions(spark, d)
    out = cascade.reassemble(plain, decided, LATIN, identity=False)
    rows = test.select(F.col("doc_id").alias("id"), F.col("text").alias("gold")).join(out, "id")
    return rows.agg(F.count(F.lit(1)).alias("texts"), F.sum((LATIN.strip(F.col("gold")) != LATIN.strip(F.col("text"))).cast("int")).alias("failures"))


def _measured(spark, d):  # noqa: ANN001, ANN202
    test, plain, decided = _decisions(spark, d)
    gold = test.select(F.col("doc_id").alias("id"), F.col("lang").alias("layer"), "text")
    return evaluate.measured(evaluate.align(gold, cascade.reassemble(plain, decided, LATIN), LATIN), LATIN)


def eval_buckets(spark, d):  # noqa: ANN001, ANN201
    rows = _measured(spark, d)
    flags = {"english": F.col("layer") == "en", "other": F.col("layer") != "en", "long": F.length("gold") >= 8}
    return evaluate.buckets(rows, flags).select("segment", "words", "wrong", "slots", "slot_errors", "wer", "cer")


def eval_confusions(spark, d):  # noqa: ANN001, ANN201
    return evaluate.confusions(_measured(spark, d))


def eval_contexts(spark, d):  # noqa: ANN001, ANN201
    test = _table(spark, d, "documents").join(held_out(spark, d), "doc_id", "left_semi").select(F.col("doc_id").alias("id"), text.words(F.col("text"), LATIN).alias("w"))
    wrong = _measured(spark, d).where("wrong = 1")
    return wrong.join(test, "id").select("id", F.col("idx").cast("long").alias("idx"), evaluate.context(F.col("w"), F.col("idx"), 3).alias("context"))


def review_contexts(spark, d):  # noqa: ANN001, ANN201
    p = review.pending(_decisions(spark, d)[2])
    return p.select("skeleton", "paragraph", F.col("position").cast("long").alias("position"), "context")


def correction_run(spark, d):  # noqa: ANN001, ANN201
    turns = _table(spark, d, "conversations").select(F.concat_ws("/", "conv_id", "turn").alias("id"), "text")
    return review.changes(review.fix(turns, _rules(spark), _overrides(spark), None, LATIN))


def length_batches(spark, d):  # noqa: ANN001, ANN201
    return runs.length_batches(_table(spark, d, "benchmark"), "text", 4, cells=4).select("item_id", "batch")


RULES = """rules(skeleton, fixed, dflt, aft, bef) as (values ('re', null, 'ré', map {'le': 'ré'}, map {'the': 're'}), ('ea', 'éa', null, map {}::map(varchar, varchar), map {}::map(varchar, varchar)), ('en', null, null, map {'the': 'èn'}, map {}::map(varchar, varchar))),
ov(scope, skeleton, form) as (values ('*', 'er', 'ér'), ('*', 'on', 'onx'), ('12', 'er', 'er'), ('28', 'in', 'ín'), ('*', 'st', ''))"""

DECISIONS = f"""with {TRAIN}, {tok_sql("train")}, {lexicon_sql()}, {RULES},
plain as (select doc_id, lang, strip_accents(text) as text from test), {tok_sql("plain", "pt")},
cand as (select p.*, coalesce(nullif(o2.form, ''), nullif(o1.form, '')) as f_override, coalesce(r.fixed, r.aft[p.prev], r.bef[p.next], r.dflt) as f_homograph,
  coalesce(pr.rabbinic, case when e.category = 'unambiguous' then e.best end) as f_lexicon, b.form as f_bigram
  from pt p left join ov o1 on o1.scope = '*' and o1.skeleton = p.skeleton left join ov o2 on o2.scope = p.doc_id::varchar and o2.skeleton = p.skeleton
  left join rules r on r.skeleton = p.skeleton left join entries e on e.skeleton = p.skeleton left join preferred pr on pr.skeleton = p.skeleton
  left join bigrams b on b.prev = p.prev and b.skeleton = p.skeleton),
won as (select *, coalesce(f_override, f_homograph, f_lexicon, f_bigram) as f,
  case when f_override is not null then 'override' when f_homograph is not null then 'homograph' when f_lexicon is not null then 'lexicon' when f_bigram is not null then 'bigram' end as src from cand),
dec as (select doc_id as id, idx, form as original, skeleton, case when strip_accents(f) = skeleton then f else form end as form, case when strip_accents(f) = skeleton then src else 'unresolved' end as source,
  coalesce(strip_accents(f) = skeleton, false) as confident, case when f is not null and strip_accents(f) <> skeleton then 'skeleton' end as note from won)"""

OUTPUT = f"""segs as (select doc_id as id, unnest(s) as piece, generate_subscripts(s, 1) as k from (select doc_id, regexp_extract_all(text, '{W}|[^A-Za-zÀ-ÖØ-öø-ÿ]+') as s from plain)),
numbered as (select *, regexp_matches(piece, '^[A-Za-zÀ-ÖØ-öø-ÿ]') as is_word, sum(regexp_matches(piece, '^[A-Za-zÀ-ÖØ-öø-ÿ]')::int) over (partition by id order by k) - 1 as idx from segs),
texts as (select n.id, string_agg(case when is_word then dec.form else piece end, '' order by k) as text from numbered n left join dec on dec.id = n.id and dec.idx = n.idx and n.is_word group by n.id)"""

MEASURED = f"""{DECISIONS}, {tok_sql("test", "gt")},
meas as (select g.doc_id as id, g.layer, g.idx, g.form as gold, dec.form as predicted, (g.form <> dec.form)::int as wrong, length(g.form) as slots,
  len(list_filter(range(1, length(g.form) + 1), lambda i: g.form[i] <> dec.form[i])) as slot_errors from gt g join dec on dec.id = g.doc_id and dec.idx = g.idx)"""

QUERIES = {f.__name__: f for f in (strip_marks, tokens, segments_lossless, mark_flags, identity_diffs, clean_pages, sentences, dedup_sentences, corpus_summary, eval_sample, eval_manifest, marker_layers, license_verdicts, heldout_antijoin, leakage_guard, content_hash, lexicon_forms, lexicon_entries, lexicon_variants, bigram_table, preferred_forms, names, review_queue, layer_sizes, quote_index, quote_collisions, quote_hits, quote_matches, cascade_decisions, cascade_by_source, cascade_text, identity_check, eval_buckets, eval_confusions, eval_contexts, review_contexts, correction_run, length_batches)}

_LETTER = "[^A-Za-zÀ-ÖØ-öø-ÿ]"

ORACLE_SQL = {
    "strip_marks": "select doc_id, md5(strip_accents(text)) as skeleton_md5 from documents",
    "tokens": f"{TOK} select doc_id, idx, form, skeleton, prev, next from tok",
    "segments_lossless": f"select doc_id, len(s) as n_segments, len(list_filter(s, lambda z: regexp_matches(z, '^[A-Za-zÀ-ÖØ-öø-ÿ]'))) as n_words, array_to_string(s, '') = text as lossless from (select doc_id, text, regexp_extract_all(text, '{W}|{_LETTER}+') as s from documents)",
    "mark_flags": f"select doc_id, strip_accents(text) <> text as has_marks, regexp_matches(text, '[A-Za-zÀ-ÖØ-öø-ÿ]') as has_letters, length(regexp_replace(text, '[^éóèñçüêäöíÉÈÑÓÇÄÊÜÖÍ]', '', 'g')) as n_marked, length(regexp_replace(text, '{_LETTER}', '', 'g')) as n_letters from documents",
    "identity_diffs": "select item_id, p as at, substr(a, greatest(p - 19, 1), 41) as a, substr(b, greatest(p - 19, 1), 41) as b from (select item_id, a, b, list_position(list_transform(range(1, length(a) + 1), lambda i: a[i] <> b[i]), true) - 1 as p from (select item_id, text as a, strip_accents(text) as b from benchmark)) where a <> b union all select item_id, null, null, null from benchmark where text = strip_accents(text)",
    "clean_pages": f"select page_id, md5({_clean_sql('html', True)}) as cleaned_md5, length({_clean_sql('html', True)}) as n from pages",
    "sentences": f"{SENTENCES} select doc_id, line_idx, sent_idx, text, n_words from sents",
    "dedup_sentences": f"{SENTENCES}, {DEDUP} select r.doc_id as doc_id, r.line_idx as line_idx, r.sent_idx as sent_idx, md5(r.text) as text_md5 from first",
    "corpus_summary": SENTENCES.replace("from documents)", "from documents where lang <> 'fr' and doc_id not in (select doc_id from labels))") + f", {DEDUP} select r.lang as layer, 'CC-BY' || case when r.lang = 'fr' then '-NC' else '' end as license, count(*) as sentences, sum(r.n_words)::bigint as words from first group by rollup (r.lang, 'CC-BY' || case when r.lang = 'fr' then '-NC' else '' end)",
    "eval_sample": f"{SAMPLE} select id, source, n_words from sample",
    "eval_manifest": f"{SAMPLE} select source, count(*) as sentences, sum(n_words)::bigint as words, count(distinct doc_id) as refs from sample group by source",
    "marker_layers": f"select doc_id, share, case when share >= 0.08 then 'marked' else lang end as layer from (select doc_id, lang, case when len(w) > 0 then len(list_filter(w, lambda z: z in ('the', 'of', 'and', 'that', 'les', 'des'))) / len(w) else 0.0 end as share from (select doc_id, lang, list_transform(regexp_extract_all(text, '{W}'), lambda z: lower(z)) as w from documents))",
    "license_verdicts": "select source, '1' as version, count(*) as sections, arg_min(license, doc_id) as license, case when arg_min(license, doc_id) like '%-NC%' then 'noncommercial' else 'ok' end as verdict, arg_min(doc_id::varchar, doc_id) as example_ref from (select *, 'CC-BY' || case when lang = 'fr' then '-NC' else '' end as license from documents) group by source",
    "heldout_antijoin": "select doc_id, lang from documents where doc_id not in (select doc_id from labels)",
    "leakage_guard": f"with {TRAIN} select doc_id, source from train where strip_accents(text) in (select strip_accents(text) from test)",
    "content_hash": "select sha256(string_agg(h, '' order by item_id, h)) as sha256 from (select item_id, sha256(concat_ws(chr(31), item_id::varchar, text)) as h from benchmark)",
    "lexicon_forms": f"{TOK} select skeleton, form, count(*) as n, min(struct_pack(a := doc_id, b := idx)).a as first_doc, min(struct_pack(a := doc_id, b := idx)).b as first_idx from tok group by skeleton, form",
    "lexicon_entries": f"{TOK}, {lexicon_sql()} select skeleton, category, best, count, most / count as ratio from entries",
    "lexicon_variants": f"{TOK}, {lexicon_sql()} select skeleton, place, form, n from (select skeleton, form, n, row_number() over (partition by skeleton order by n desc, first, form) - 1 as place from counts) where place < 6",
    "bigram_table": f"{TOK}, {lexicon_sql()} select prev, skeleton, form from bigrams",
    "preferred_forms": f"{TOK}, {lexicon_sql()} select skeleton, rabbinic from preferred",
    "names": f"{TOK} select skeleton, count(*) as n from tok where prev in ('the', 'der', 'el', 'le') and skeleton not in ('the', 'der', 'el', 'le') group by skeleton having count(*) >= 2",
    "review_queue": f"{TOK}, {lexicon_sql()} select skeleton, count, n_variants from (select skeleton, count, (select least(count(*), 6) from counts c where c.skeleton = entries.skeleton) as n_variants from entries where category = 'ambiguous' order by count desc, seen limit 5000)",
    "layer_sizes": f"{TOK} select layer, count(distinct skeleton) as skeletons, count(*) as tokens from tok group by layer",
    "quote_index": f"with {QUOTES} select key, span_id, off from idx",
    "quote_collisions": f"with s as (select list_transform(regexp_extract_all(text, '{W}'), lambda z: lower(z)) as f from documents), g as (select array_to_string(list_transform(f[o + 1 : o + 4], lambda z: strip_accents(z)), ' ') as key, array_to_string(f[o + 1 : o + 4], ' ') as ff from s, lateral (select unnest(range(len(f) - 3)) as o) where len(f) >= 4) select key, count(distinct ff) as n_forms from g group by key having count(distinct ff) > 1",
    "quote_hits": f"with {QUOTES} select id, i, span_id, off from hits",
    "quote_matches": f"""with recursive {QUOTES}, runs as (select h.id, i, h.span_id, off, 4 + coalesce(list_position(list_transform(range(greatest(0, least(len(s) - i - 4, len(f) - off - 4))), lambda t: s[i + 5 + t] <> strip_accents(f[off + 5 + t])), true) - 1, greatest(0, least(len(s) - i - 4, len(f) - off - 4))) as run
from hits h join qry q on q.id = h.id join src on src.span_id = h.span_id),
pick as (select id, min(i) as i from runs group by id union all select p.id, (select min(r.i) from runs r where r.id = p.id and r.i >= p.i + cur.run) from pick p join runs cur on cur.id = p.id and cur.i = p.i where (select min(r.i) from runs r where r.id = p.id and r.i >= p.i + cur.run) is not null)
select runs.id, runs.i as start, runs.i + run as "end", span_id, off from pick join runs using (id, i)""",
    "cascade_decisions": f"{DECISIONS} select id, idx, skeleton, form, source, confident, note from dec",
    "cascade_by_source": f"{DECISIONS} select source, count(*) as n from dec group by source",
    "cascade_text": f"{DECISIONS}, {OUTPUT} select id, md5(text) as text_md5 from texts",
    "identity_check": f"{DECISIONS}, {OUTPUT} select count(*) as texts, sum((strip_accents(d.text) <> strip_accents(texts.text))::int)::bigint as failures from texts join documents d on d.doc_id = texts.id",
    "eval_buckets": f"{MEASURED} select segment, count(*) as words, sum(wrong)::bigint as wrong, sum(slots)::bigint as slots, sum(slot_errors)::bigint as slot_errors, sum(wrong) / count(*) as wer, sum(slot_errors) / sum(slots) as cer from (select *, unnest(list_filter(['overall', case when layer = 'en' then 'english' end, case when layer <> 'en' then 'other' end, case when length(gold) >= 8 then 'long' end], lambda z: z is not null)) as segment from meas) group by segment",
    "eval_confusions": f"{MEASURED} select gold, predicted, count(*) as n from meas where wrong = 1 group by gold, predicted order by n desc, min(struct_pack(a := id, b := idx)) limit 25",
    "eval_contexts": f"{MEASURED} select id, idx, array_to_string(w[greatest(idx - 2, 1) : idx + 4], ' ') as context from meas join gt_w on gt_w.doc_id = meas.id where wrong = 1",
    "review_contexts": f"{DECISIONS} select skeleton, id as paragraph, idx as position, array_to_string(w[greatest(idx - 4, 1) : idx + 6], ' ') as context from (select *, row_number() over (partition by skeleton order by id, idx) as r from dec where not confident) x join pt_w on pt_w.doc_id = x.id where r <= 3",
    "correction_run": f"with {RULES}, conv as (select conv_id || '/' || turn as doc_id, '' as lang, text from conversations), {tok_sql('conv')}, ans as (select form as old, coalesce(nullif(o.form, ''), r.fixed, r.aft[t.prev], r.bef[t.next], r.dflt) as new, t.skeleton from (select * from tok) t left join rules r on r.skeleton = t.skeleton left join (select skeleton as sk, form from ov where scope = '*') o on o.sk = t.skeleton) select old, new, count(*) as n from ans where new is not null and strip_accents(new) = skeleton and old <> new group by old, new order by n desc, old, new limit 60".replace("select form as old", "select t.form as old"),
    "length_batches": "select item_id, cell || '-' || ((row_number() over (partition by cell order by length(text), text) - 1) // 4) as batch from (select *, ('0x' || substr(md5(text), 1, 4))::int % 4 as cell from benchmark)",
}
