"""Registered queries of the Hebrew functions over inline fixtures; their SQL twins are tables of the expected rows."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, clean, spelling, text
from ..operators import cascade, haser, quotes, runs
from ..profile import HEBREW
from ..sources import tables

def _n(s: str) -> str:
    return unicodedata.normalize("NFC", s)


def _flag(c: Column) -> Column:
    return c.cast("string")



def _functions() -> dict[str, Column]:
    t = F.col("t")
    return {
        "strip": text.strip(t),
        "acronym": _flag(text.is_acronym(t)),
        "words": F.array_join(text.words(t), "/"),
        "canonical": text.canonical(t),
        "mater": text.fix_mater_vowels(t),
        "clean": clean.clean_line(t),
        "marked": _flag(clean.is_fully_marked(t)),
        "sentences": F.size(clean.sentences(t)).cast("string"),
        "to_male": spelling.to_male(t),
        "positions": F.array_join(F.transform(spelling.mater_positions(t), lambda x: x["pos"].cast("string")), ","),
        "mechanical": spelling.mechanical(t, spelling.mater_positions(t)),
        "construct": _flag(classify.is_construct(t)),
        "aramaic": _flag(classify.is_aramaic(t)),
        "license": classify.license_verdict(t),
        "chunks": F.array_join(F.transform(text.model_chunks(t, 6), lambda c: F.length(c).cast("string")), ","),
        "labels": text.apply_labels(text.char_labels(t, CLASSES), CLASSES),
    }


CLASSES = ["", chr(0x05BC), *(chr(c) for c in range(0x05B0, 0x05BC)), *(chr(c) + chr(0x05BC) for c in range(0x05B0, 0x05BC)), chr(0x05C7), chr(0x05C7) + chr(0x05BC)]

#: (function, input, expected)
FIXTURES = [
    ("strip", "בְּרֵאשִׁית בָּרָא אֱלֹהִים", "בראשית ברא אלהים"),
    ("strip", "כׇּל־הַנְּשָׁמָה תְּהַלֵּל יָהּ׃", "כל־הנשמה תהלל יה׃"),
    ("strip", "בְּרֵאשִׁ֖ית בָּרָ֣א אֱלֹהִ֑ים", "בראשית ברא אלהים"),
    ("acronym", 'רמב"ם', "true"),
    ("acronym", "ע'", "true"),
    ("acronym", "שלום", "false"),
    ("acronym", 'צפוי"', "false"),
    ("words", "אָב, בֵּן; רוּחַ", "אָב/בֵּן/רוּחַ"),
    ("canonical", "בְּ", "בְּ"),
    ("canonical", "שָּׁ֖לוֹם", "שָּׁלוֹם"),
    ("mater", "אֲרֻוכָּה", "אֲרוּכָּה"),
    ("mater", "נְקֻודָּה", "נְקוּדָּה"),
    ("mater", "בְּאֹופֶן", "בְּאוֹפֶן"),
    ("mater", "קֹודֶם", "קוֹדֶם"),
    *(("mater", w, w) for w in ("שָׁלוֹם", "הוּא", "מִצְוָה", "עָלָיו", "תּוֹרָה", "כֻּלָּם", "עֲוֹן", "וְלֹא", "תִּקְוָה")),
    ("clean", "<b>שָׁלוֹם</b> {הערה} [1] עוֹלָם", "שָׁלוֹם עוֹלָם"),
    ("clean", "א* [ב] abc x", "א x"),
    ("marked", "אָמַר רַבִּי עֲקִיבָא", "true"),
    ("marked", "אָמַר רבי עקיבא שלום עולם", "false"),
    ("sentences", "אָמַר רַבִּי עֲקִיבָא׃ בָּרָא אֱלֹהִים אֵת׃", "2"),
    ("to_male", "חִבּוּר", "חִיבּוּר"),
    ("to_male", "כֻּלָּם", "כּוּלָּם"),
    *(("to_male", w, w) for w in ("בַּיִת", "לָרִאשׁוֹן", "וְיִגְאֹל", "רַבִּי")),
    ("positions", "חִיבּוּר", "1,3"),
    ("positions", "כּוּלָּם", "1"),
    *(("positions", w, "") for w in ("רַבִּי", "חַיִּים")),
    ("positions", "הִיא", "1"),
    ("mechanical", "כּוּלָּם", "כֻּלָּם"),
    ("construct", "בֵּית", "true"),
    ("construct", "מַלְכֵי", "true"),
    ("construct", "שָׁלוֹם", "false"),
    ("aramaic", "מאי טעמא", "true"),
    ("aramaic", "בראשית ברא אלהים", "false"),
    ("license", "CC-BY-NC", "noncommercial"),
    ("license", "", "unknown"),
    ("license", "CC0", "ok"),
    ("chunks", "אב גד הו זח", "6,5"),
    ("labels", "שָׂשׂוֹן וְשִׂמְחָה", "שָׂשׂוֹן וְשִׂמְחָה"),
    ("labels", "כׇּל־הַנְּשָׁמָה", "כׇּל־הַנְּשָׁמָה"),
]


def hebrew_functions(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([(i, f, _n(x)) for i, (f, x, _) in enumerate(FIXTURES)], "id long, fn string, t string")
    value = F.coalesce(*[F.when(F.col("fn") == n, c) for n, c in _functions().items()])
    return rows.select("id", "fn", value.alias("value"))


MATCHES = [("שָׂם", "שָׁם", False, True, 1, 2), ("בְּ", "בְּ", True, True, 0, 1), ("שָׁלוֹם", "שָׁלוּם", False, False, 1, 4), ("אב", "אבג", False, False, 3, 3), (chr(0xFB2A) + "ם", "שׁם", True, True, 0, 2), ("ײן", "יין", True, True, 0, 3)]


def hebrew_matches(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([(i, m[0], m[1]) for i, m in enumerate(MATCHES)], "id long, a string, b string")
    a, b = F.col("a"), F.col("b")
    e = text.char_errors(a, b)
    return rows.select("id", text.word_matches(a, b).alias("same"), text.word_matches(a, b, ignore_shin=True).alias("same_but_shin"), e["errors"].cast("long").alias("errors"), e["slots"].cast("long").alias("slots"))


LEXICON = [("שלום", "unambiguous", "שָׁלוֹם", None), ("ספר", "context", "סֵפֶר", None), ("זכר", "ambiguous", "זָכָר", None)]
BIGRAMS = [("בבית", "ספר", "סֵפֶר"), ("אמר", "ספר", "סָפַר")]
#: (text, overrides, homographs, expected text, expected sources)
CASCADES = [
    ("שלום", "שָׁלוֹם", "lexicon"),
    ("אמר ספר", "אמר סָפַר", "unresolved,bigram"),
    ("בבית ספר", "בבית סֵפֶר", "unresolved,bigram"),
    ("זכר", "זכר", "unresolved"),
    ('שלום רמב"ם', 'שָׁלוֹם רמב"ם', "lexicon,acronym"),
    ("שָׁלֹם", "שָׁלֹם", "preexisting"),
    ("על תורה", "על תּוֹרָה", "unresolved,homograph"),
    ("גוי", "גוֹי", "override"),
    ("בית", "בית", "unresolved"),
    ("שלום, זכר — (ספר) 1234 hello!", "שָׁלוֹם, זכר — (ספר) 1234 hello!", "lexicon,unresolved,unresolved"),
]


def hebrew_cascade(spark: SparkSession, d: str) -> DataFrame:
    texts = spark.createDataFrame([(i, _n(c[0])) for i, c in enumerate(CASCADES)], "id long, text string")
    res = cascade.Resources(
        spark.createDataFrame([tuple(x and _n(x) for x in r) for r in LEXICON], "skeleton string, category string, best string, rabbinic string"),
        spark.createDataFrame([tuple(map(_n, r)) for r in BIGRAMS], tables.BIGRAMS),
        tables.parse_homographs(spark.createDataFrame([(_n("תורה"), _n('{"after": {"על": "תּוֹרָה"}}'))], "skeleton string, json string")),
        spark.createDataFrame([("*", _n("גוי"), _n("גוֹי")), ("*", _n("בית"), _n("בַּיִתא"))], tables.OVERRIDES),
    )
    decided = cascade.decide(texts, res, HEBREW)
    sources = decided.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "source"))), lambda x: x["source"]), ",").alias("sources"))
    return cascade.reassemble(texts, decided, HEBREW).join(sources, "id").select("id", "text", "sources")


QUOTED = [(1, "בְּרֵאשִׁית בָּרָא אֱלֹהִים אֵת הַשָּׁמַיִם וְאֵת הָאָרֶץ"), (2, "מֵאֵימָתַי קוֹרִין אֶת שְׁמַע בְּעַרְבִית")]
QUERIED = [(1, "בראשית ברא אלהים את השמים"), (2, "ברא אלהים"), (3, "ואת הארץ מאימתי קורין את שמע"), (4, "כי בראשית ברא אלהים את")]


def hebrew_quotes(spark: SparkSession, d: str) -> DataFrame:
    src = spark.createDataFrame([(i, _n(x)) for i, x in QUOTED], "span long, text string")
    forms = text.words(F.col("text"))
    src = quotes.spans(src, F.transform(forms, text.canonical), F.transform(forms, HEBREW.strip), "span")
    queries = spark.createDataFrame([(i, _n(x)) for i, x in QUERIED], "id long, text string").select("id", text.words(F.col("text")).alias("skeletons"))
    return quotes.quoted_tokens(quotes.matches(queries, quotes.index(src), src), src).select("id", F.col("idx").cast("long").alias("idx"), "form", "span_id")


#: Counted variants by skeleton, and what becomes of full spellings with them.
HASER_LEXICON = [
    ("חבור", [("חִבּוּר", 260), ("חָבוֹר", 3)]),
    ("חיבור", [("חִיבּוּר", 38)]),
    ("כלם", [("כֻּלָּם", 232), ("כֻלָּם", 28)]),
    ("אש", [("אֵשׁ", 269)]),
    ("הא", [("הָא", 5819), ("הִא", 1)]),
    ("תקון", [("תַּקּוּן", 23), ("תִקּוּן", 17), ("תִּקּוּן", 15)]),
]
HASER = [("חִיבּוּר", "חִבּוּר", "1", "י"), ("כּוּלָּם", "כֻּלָּם", "1", "ו"), ("הַחִיבּוּר", "הַחִבּוּר", "2", "י"), ("תִּיקּוּן", "תִּקּוּן", "1", "י")]


def hebrew_haser(spark: SparkSession, d: str) -> DataFrame:
    lex = spark.createDataFrame([(s, [(_n(f), n) for f, n in v]) for s, v in HASER_LEXICON], "skeleton string, variants array<struct<form:string,n:bigint>>")
    forms = spark.createDataFrame([(_n(x),) for x in (*(h[0] for h in HASER), "אִישׁ", "הִיא", "רַבִּי", "חַיִּים")], "form string")
    out = haser.convert(forms, lex)
    letters = F.transform("removed", lambda r: r["letter"])
    restored = spelling.restore(HEBREW.strip(F.col("converted")), F.transform("removed", lambda r: F.struct(r["pos"].alias("pos"), r["letter"].alias("letter"))))
    return out.select("form", "converted", F.array_join(F.transform("removed", lambda r: r["pos"].cast("string")), ",").alias("removed"), F.array_join(letters, ",").alias("letters"), (restored == HEBREW.strip(F.col("form"))).alias("restorable"))


#: (spelling, text, expected text, expected sources, letters removed); the last rows are lines of a source, known to the quotation layer.
SPELLED = [("male", "חיבור", "חִיבּוּר", "lexicon", ""), ("haser", "חיבור", "חִבּוּר", "haser", "י"), ("haser", "על חיבור, זה", "על חִבּוּר, זה", "unresolved,haser,unresolved", "י"), ("haser", "חִיבּוּר", "חִיבּוּר", "preexisting", ""), ("haser", "אש", "אֵשׁ", "lexicon", "")]


def _lexicon_with_variants(spark: SparkSession) -> DataFrame:
    rows = [(s, "unambiguous", _n(v[0][0]), None, [(_n(f), n) for f, n in v]) for s, v in HASER_LEXICON]
    return spark.createDataFrame(rows, "skeleton string, category string, best string, rabbinic string, variants array<struct<form:string,n:bigint>>")


def hebrew_spellings(spark: SparkSession, d: str) -> DataFrame:
    res = cascade.Resources(_lexicon_with_variants(spark))
    out = None
    for ktiv in ("male", "haser"):
        texts = spark.createDataFrame([(i, _n(x[1])) for i, x in enumerate(SPELLED) if x[0] == ktiv], "id long, text string")
        vocalized, decided = haser.vocalize(texts, res, ktiv)
        if ktiv == "male":
            decided = decided.withColumn("removed", F.lit(None).cast("array<struct<pos:int,vowel:string,letter:string>>"))
        letters = F.array_join(F.transform(F.coalesce("removed", F.array().cast("array<struct<pos:int,vowel:string,letter:string>>")), lambda r: r["letter"]), "")
        words = decided.select("id", F.struct("idx", "source", letters.alias("letters")).alias("w")).groupBy("id").agg(F.array_sort(F.collect_list("w")).alias("w"))
        rows = vocalized.join(words, "id").select("id", F.lit(ktiv).alias("ktiv"), "text", F.array_join(F.transform("w", lambda w: w["source"]), ",").alias("sources"), F.array_join(F.transform("w", lambda w: w["letters"]), "").alias("letters"))
        out = rows if out is None else out.unionByName(rows)
    return out


#: (text, expected text, expected sources) with the lexicon and the quotation layer.
QUOTING = [("בראשית ברא אלהים את השמים", " ".join(QUOTED[0][1].split()[:5]), "quote,quote,quote,quote,quote"), ("ברא אלהים", "ברא אלהים", "unresolved,unresolved"), ("אש: מאימתי קורין את שמע", "אֵשׁ: " + " ".join(QUOTED[1][1].split()[:4]), "lexicon,quote,quote,quote,quote")]


def hebrew_engine(spark: SparkSession, d: str) -> DataFrame:
    src = spark.createDataFrame([(i, _n(x)) for i, x in QUOTED], "span long, text string")
    forms = text.words(F.col("text"))
    src = quotes.spans(src, F.transform(forms, text.canonical), F.transform(forms, HEBREW.strip), "span")
    texts = spark.createDataFrame([(i, _n(x[0])) for i, x in enumerate(QUOTING)], "id long, text string")
    queries = texts.select("id", F.transform(text.words(F.col("text")), HEBREW.strip).alias("skeletons"))
    quoted = quotes.quoted_tokens(quotes.matches(queries, quotes.index(src), src), src)
    res = cascade.engine("lexicon+quotes", cascade.Resources(_lexicon_with_variants(spark), quotes=quoted))
    decided = cascade.decide(texts, res, HEBREW)
    sources = decided.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "source"))), lambda x: x["source"]), ",").alias("sources"))
    return cascade.reassemble(texts, decided, HEBREW).join(sources, "id").select("id", "text", "sources")


RUNS = [(["אמר ", "רבי ", "עקיבא"], "אָמַר רַבִּי עֲקִיבָא", ["אָמַר ", "רַבִּי ", "עֲקִיבָא"]), (["של", "ום"], "שָׁלוֹם", ["שָׁל", "וֹם"]), (["שלום", ""], "שָׁלוֹם", ["שָׁלוֹם", ""])]


def hebrew_runs(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([(i, r[0], _n(r[1])) for i, r in enumerate(RUNS)], "id long, runs array<string>, out string")
    return rows.select("id", F.array_join(runs.redistribute(F.col("runs"), F.col("out")), "|").alias("pieces"))


def section_refs(spark: SparkSession, d: str) -> DataFrame:
    books = spark.createDataFrame([("Genesis", 3, "chapter"), ("Berakhot", 4, "folio")], "book string, chapters int, style string")
    return tables.section_refs(books)


def _values(rows: list[tuple], names: str) -> str:
    one = lambda v: "null" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + _n(v).replace("'", "''") + "'"
    return f"select * from (values {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) x({names})"


def _quote_rows() -> list[tuple]:
    verse, mishnah = QUOTED[0][1].split(), QUOTED[1][1].split()
    return [*((1, k, verse[k], 1) for k in range(5)), *((3, 2 + k, mishnah[k], 2) for k in range(4)), *((4, 1 + k, verse[k], 1) for k in range(4))]


QUERIES = {f.__name__: f for f in (hebrew_functions, hebrew_matches, hebrew_cascade, hebrew_quotes, hebrew_haser, hebrew_spellings, hebrew_engine, hebrew_runs, section_refs)}

ORACLE_SQL = {
    "hebrew_functions": _values([(i, f, x) for i, (f, _, x) in enumerate(FIXTURES)], "id, fn, value"),
    "hebrew_matches": _values([(i, *m[2:]) for i, m in enumerate(MATCHES)], "id, same, same_but_shin, errors, slots"),
    "hebrew_cascade": _values([(i, c[1], c[2]) for i, c in enumerate(CASCADES)], "id, text, sources"),
    "hebrew_quotes": _values(_quote_rows(), "id, idx, form, span_id"),
    "hebrew_haser": _values([(*h, True) for h in HASER], "form, converted, removed, letters, restorable"),
    "hebrew_spellings": _values([(i, x[0], *x[2:]) for i, x in enumerate(SPELLED)], "id, ktiv, text, sources, letters"),
    "hebrew_engine": _values([(i, x[1], x[2]) for i, x in enumerate(QUOTING)], "id, text, sources"),
    "hebrew_runs": _values([(i, "|".join(map(_n, r[2]))) for i, r in enumerate(RUNS)], "id, pieces"),
    "section_refs": "select 'Genesis' as book, 'Genesis ' || i as ref from range(1, 4) r(i) union all select 'Berakhot', 'Berakhot ' || x from (values ('2a'), ('2b'), ('3a'), ('3b')) v(x)",
}
