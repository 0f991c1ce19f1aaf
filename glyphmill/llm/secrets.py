"""Secret scans with a random forest for false positives, in DataFrame functions only.

Candidates are private-key blocks and runs of at least 16 letters, digits and _ + / - (with = behind them as padding) that hold a letter and a digit;
a run begins behind NAME= or NAME:. Tokens that show their issuer need no digit, and a JSON web token is one candidate with its dots. Each has features:
length, character classes and their transitions, common letter pairs, cover by dictionary words, distinct
characters, path signs around it, and neighbouring words that speak for or against a secret. A random forest, trained in the JVM from
labelled findings, gives the share of its trees' votes; its trees become CASE expressions, so scoring stays inside the scan's
stage: no shuffle, no join, no Python.

Findings are labelled rows (value, before, behind, label); where a caller has none, labelled_findings() makes a fixed set of them from
patterns of credentials and of look-alikes (digests, identifiers, paths, placeholders).

Defined results: null and empty texts have no findings; repeated rows have findings each; positions are code points
from 0; extra columns are ignored by scan() and kept by redact(); an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "[A-Za-z0-9_+/-]"
PADDING = "(?:={1,2}(?![A-Za-z0-9_+/=-]))?"
#: A run with a value behind = is that value's name.
UNNAMED = "(?!=[\"']?[A-Za-z0-9_+/-])"
#: To its END line, with header lines; without one, as far as base64 goes.
KEY_BLOCK = "-----BEGIN [A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----(?:[^-]*+(?:-(?!----)[^-]*+){0,200}+-----END [A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----|[A-Za-z0-9+/=\\s]*+)"
#: Three dotted parts, the first one the JSON of a header in base64.
JWT = "(?<![A-Za-z0-9_.-])eyJ[A-Za-z0-9_-]{8,}+\\.[A-Za-z0-9_-]{8,}+\\.[A-Za-z0-9_-]{8,}+"
#: How tokens of well-known issuers begin.
ISSUED = "(?:gh[opsur]_|github_pat_|glpat-|AKIA|ASIA|[srp]k_(?:live|test)_|xox[abpr]-)"
CANDIDATE = f"{KEY_BLOCK}|{JWT}|(?<!{RUN}){ISSUED}{RUN}{{14,}}+{PADDING}|(?<!{RUN})(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z]){RUN}{{16,}}+{PADDING}{UNNAMED}"
CONTEXT = 48
BLOCK = 256
ACCEPT = 0.5
MASK = "[SECRET]"
#: Words of code and prose that names, slugs and paths are made of.
DICTIONARY = ["able", "access", "account", "active", "address", "admin", "archive", "array", "article", "author", "backup", "base", "block", "book", "branch", "build", "button", "cache", "change", "check", "class", "client", "cluster", "code", "column", "commit", "common", "config", "content", "control", "count", "data", "date", "default", "delete", "device", "document", "download", "email", "entry", "error", "event", "example", "export", "field", "file", "filter", "first", "folder", "format", "frame", "group", "guide", "handler", "header", "history", "home", "host", "image", "import", "index", "input", "insert", "item", "language", "last", "library", "line", "link", "list", "local", "login", "mail", "main", "manager", "message", "method", "model", "module", "name", "network", "node", "note", "number", "object", "option", "order", "output", "package", "page", "parent", "path", "photo", "placeholder", "point", "policy", "pool", "post", "process", "product", "profile", "project", "public", "python", "query", "queue", "read", "record", "release", "remote", "report", "request", "result", "return", "sample", "schema", "script", "search", "section", "server", "service", "session", "share", "simple", "size", "source", "start", "state", "static", "status", "store", "stream", "string", "style", "system", "table", "target", "task", "template", "test", "text", "thread", "time", "title", "token", "type", "update", "upload", "user", "value", "version", "video", "view", "window", "word", "work", "write", "your"]
PAIRS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|ea|ra|ce|li|ch|ll|be|ma|si|om|ur"
SPEAKS_FOR = "(?i)token|secret|passw|pwd|api.?key|apikey|auth|bearer|credential|private|access.?key|client.?key|signing"
SPEAKS_AGAINST = "(?i)commit|sha-?[0-9]|md5|checksum|hash|digest|uuid|guid|revision|etag|integrity|example|build.?id|trace|request.?id|cache.?key|version"
FEATURES = ["size", "upper", "lower", "digits", "signs", "turns", "pairs", "words", "distinct", "hex", "path", "dotted", "assigned", "quoted", "speaks_for", "speaks_against", "repeats", "issued"]


def features(value: Column, before: Column, behind: Column) -> list[Column]:
    """FEATURES of a candidate with the text before and behind it."""
    n = F.greatest(F.length(value), F.lit(1)).cast("double")
    share = lambda pattern: 1.0 - F.length(F.regexp_replace(value, pattern, "")) / n
    small = F.lower(value)
    yes = lambda c: c.cast("double")
    return [
        F.least(n, F.lit(256.0)),
        share("[A-Z]"),
        share("[a-z]"),
        share("[0-9]"),
        share("[^A-Za-z0-9]"),
        F.length(F.regexp_replace(value, "[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+", "x")) / n,
        (n - F.length(F.regexp_replace(small, PAIRS, "x"))) / n,
        1.0 - F.length(F.regexp_replace(small, "|".join(DICTIONARY), "")) / n,
        F.size(F.array_distinct(F.split(F.substring(value, 1, 256), ""))) / F.least(n, F.lit(256.0)),
        yes(value.rlike("^[0-9a-fA-F]+$")),
        F.length(F.regexp_replace(value, "[^/]", "")) + yes(before.rlike("[/\\\\]$")),
        yes(before.rlike("[.@]$") | behind.rlike("^[.@][A-Za-z0-9]")),
        yes(before.rlike("[=:]\\s*[\"']?$")),
        yes(before.rlike("[\"']$") & behind.rlike("^[\"']")),
        yes(F.right(before, F.lit(28)).rlike(SPEAKS_FOR)),
        yes(F.right(before, F.lit(28)).rlike(SPEAKS_AGAINST)),
        yes(value.rlike("(.)\\1{4}")),
        yes(value.rlike(f"^{ISSUED}") | value.rlike(f"^{JWT}")),
    ]


def labelled_findings(spark: SparkSession, rows: int = 6000) -> DataFrame:
    """A fixed set of labelled findings (value, before, behind, label, kind), made from MD5 digests of the row number."""
    n = F.col("id").cast("string")
    hexes = F.concat(F.md5(F.concat(n, F.lit("a"))), F.md5(F.concat(n, F.lit("b"))))
    base = F.regexp_replace(F.base64(F.unhex(hexes)), "[+/=]", "")
    pick = lambda salt, options: F.element_at(F.array(*map(F.lit, options)), (F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(len(options))) + 1).cast("int"))
    word = lambda salt: pick(salt, DICTIONARY)
    number = F.pmod(F.col("id") * 7919, F.lit(9973)).cast("string")
    secret = pick("kind", ["hex40", "hex32", "hex64", "base", "ghp", "akia", "live", "upper", "jwt"])
    values = {"hex40": F.substring(hexes, 1, 40), "hex32": F.substring(hexes, 1, 32), "hex64": hexes, "base": F.substring(base, 1, 32), "ghp": F.concat(F.lit("ghp_"), F.substring(base, 1, 36)), "akia": F.concat(F.lit("AKIA"), F.upper(F.substring(base, 1, 16))), "live": F.concat(F.lit("sk_live_"), F.substring(base, 1, 24)), "upper": F.upper(F.substring(hexes, 1, 40)), "jwt": F.concat(F.lit("eyJhbGciOiJIUzI1NiJ9.eyJ"), F.substring(base, 1, 20), F.lit("."), F.reverse(base))}
    chosen = F.coalesce(*[F.when(secret == k, v) for k, v in values.items()])
    before = pick("before", ['token = "', 'secret: "', 'api_key="', "Authorization: Bearer ", 'password = "', "export AUTH_TOKEN=", "access_key: ", "client_secret=", 'TOKEN = "', "private key ", "x-api-key: ", "auth token "])
    # Tokens that show their issuer stand alone in half of their rows.
    alone = secret.isin("ghp", "akia", "live", "jwt") & (F.pmod(F.xxhash64(F.lit("alone"), "id"), F.lit(2)) == 0)
    before_real = F.when(alone, pick("bare", ["see ", "the ", "in ", "= ", ": ", '"', "from ", "", "(", "- "])).otherwise(before)
    behind = F.when(F.substring(before, -1, 1) == '"', F.lit('" ')).otherwise(F.lit(" "))
    lead = F.concat(word("w1"), F.lit(" "), word("w2"), F.lit(" "))
    real = F.struct(chosen.alias("value"), F.concat(lead, before_real).alias("before"), F.concat(behind, word("w3")).alias("behind"), F.lit(1).alias("label"), F.concat(secret, F.when(alone, " alone").otherwise("")).alias("kind"))
    look = pick("look", ["digest", "slug", "name", "path", "uuid", "filler", "host", "plain", "glued"])
    digest = F.substring(hexes, F.lit(1), pick("hexlen", [40, 32, 64]))
    fake_value = (
        F.when(look == "digest", digest)
        .when(look == "slug", F.concat_ws("-", word("w4"), word("w5"), word("w6"), number, word("w7")))
        .when(look == "name", F.concat_ws("_", word("w4"), word("w5"), word("w6"), number))
        .when(look == "path", F.concat(F.lit("/"), F.concat_ws("/", word("w4"), word("w5"), word("w6")), number))
        .when(look == "uuid", F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4), F.substring(hexes, 13, 4), F.substring(hexes, 17, 4), F.substring(hexes, 21, 12)))
        .when(look == "filler", F.concat(F.repeat(pick("fill", ["x", "X", "0", "a"]), 20), number))
        .when(look == "host", F.concat(word("w4"), word("w5"), number, word("w6"), F.lit("x")))
        .when(look == "plain", F.concat(F.initcap(word("w4")), F.initcap(word("w5")), F.initcap(word("w6")), number))
        .otherwise(F.concat(word("w4"), word("w5"), word("w6"), word("w7"), F.substring(number, 1, 1)))
    )
    fake_before = F.when(look == "digest", pick("against", ["commit ", "sha256: ", "md5 = ", "checksum: ", 'digest "', "revision ", "etag: ", "integrity sha1-", "hash "])).when(look == "filler", before).when(look == "host", pick("at", ["www.", "user@", "mail."])).otherwise(pick("plain", ["see ", "the ", "in ", "= ", ": ", '"', "from ", "token "]))
    fake = F.struct(fake_value.alias("value"), F.concat(lead, fake_before).alias("before"), F.concat(F.when(look == "host", F.lit(".com")).otherwise(F.lit(" ")), word("w3")).alias("behind"), F.lit(0).alias("label"), look.alias("kind"))
    return spark.range(rows).select(F.when(F.col("id") % 2 == 0, real).otherwise(fake).alias("f")).select("f.*")


class Forest:
    """A random forest as nested CASE expressions over FEATURES."""

    def __init__(self, trees: list) -> None:
        self.trees = trees

    @classmethod
    def train(cls, findings: DataFrame, trees: int = 20, depth: int = 6, seed: int = 7) -> Forest:
        """From labelled findings (value, before, behind, label), cut as a scan would; MLlib, in the JVM."""
        from pyspark.ml.classification import RandomForestClassifier
        from pyspark.ml.feature import VectorAssembler

        rows = as_scanned(findings).select(*(c.cast("double").alias(n) for n, c in zip(FEATURES, features(F.col("value"), F.col("before"), F.col("behind")), strict=True)), F.col("label").cast("double"))
        rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label").coalesce(1).cache()
        model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxBins=64).fit(rows)
        rows.unpersist()

        def nodes(node):  # noqa: ANN001, ANN202
            if node.numDescendants() == 0:
                stats = list(node.impurityStats().stats())
                return stats[1] / (sum(stats) or 1.0)
            split = node.split()
            return (split.featureIndex(), split.threshold(), nodes(node.leftChild()), nodes(node.rightChild()))

        return cls([nodes(t._java_obj.rootNode()) for t in model.trees])

    def votes(self, at: list[Column]) -> Column:
        """The trees' mean share of real secrets."""

        def case(node) -> Column:  # noqa: ANN001
            return F.lit(float(node)) if not isinstance(node, tuple) else F.when(at[node[0]] <= F.lit(node[1]), case(node[2])).otherwise(case(node[3]))

        return reduce(lambda a, b: a + b, map(case, self.trees)) / float(len(self.trees))


def _let(value: Column, body) -> Column:  # noqa: ANN001
    """body(value) with value evaluated once: inside a lambda, an expression from outside would run again for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sums_before(lengths: Column) -> Column:
    """For each length the sum of those before it. Folds copy what they have built, so they go over blocks of BLOCK lengths, not over all of them."""
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<long>").alias("out"))
    fold = lambda a: F.aggregate(a, zero, lambda s, n: F.struct((s["sum"] + n).alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out")), lambda s: s["out"])
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, n: s + n)
    blocks = _let(lengths, lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), lambda k: F.slice(x, k * BLOCK + 1, F.lit(BLOCK))))
    return _let(blocks, lambda x: F.flatten(F.zip_with(x, fold(F.transform(x, total)), lambda block, start: F.transform(fold(block), lambda n: n + start))))


def _placed(found: Column, between: Column) -> Column:
    n = F.size(found)
    last, following = F.concat(F.array(F.lit("")), F.slice(found, 1, n - 1)), F.concat(F.slice(found, 2, n), F.array(F.lit("")))
    before = F.zip_with(last, F.slice(between, 1, n), lambda v, gap: F.right(F.concat(v, gap), F.lit(CONTEXT)))
    behind = F.zip_with(F.slice(between, 2, n), following, lambda gap, v: F.substring(F.concat(gap, v), 1, CONTEXT))
    gaps = F.transform(F.slice(between, 1, n), lambda gap: F.length(gap).cast("long"))
    starts = F.zip_with(_sums_before(F.zip_with(gaps, found, lambda gap, v: gap + F.length(v))), gaps, lambda s, gap: s + gap)
    values = F.zip_with(starts, found, lambda s, v: F.struct(s.alias("start"), v.alias("value")))
    around = F.zip_with(before, behind, lambda b, h: F.struct(b.alias("before"), h.alias("behind")))
    return F.zip_with(values, around, lambda p, c: F.struct(p["start"].alias("start"), p["value"].alias("value"), c["before"].alias("before"), c["behind"].alias("behind")))


def candidates(text: Column) -> Column:
    """array of (start, value, before, behind) for a text; the words around a candidate may be those of its neighbours.

    Every step goes over whole arrays, so a text's cost is linear in its candidates (but for _sums_before(), whose power is 1.5 at most).
    """
    both = F.struct(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found"), F.split(text, CANDIDATE, -1).alias("between"))
    return F.when(text.rlike(CANDIDATE), _let(both, lambda x: _placed(x["found"], x["between"])))


def as_scanned(labelled: DataFrame) -> DataFrame:
    """Labelled findings as a scan cuts them: a candidate on the value has its label, one beside it (a name, say) is none."""
    n = F.length("before")
    rows = labelled.select("label", n.alias("from"), (n + F.length("value")).alias("to"), F.explode(candidates(F.concat("before", "value", "behind"))).alias("c"))
    on = (F.col("c.start") < F.col("to")) & (F.col("c.start") + F.length("c.value") > F.col("from"))
    return rows.select("c.value", "c.before", "c.behind", F.when(on, F.col("label")).otherwise(0).alias("label"))


def findings(text: Column, forest: Forest) -> Column:
    """array of (start, value, score) for a text; the scores come from the forest, 1.0 for key blocks."""
    rows = F.transform(candidates(text), lambda c: F.struct(c["start"].alias("start"), c["value"].alias("value"), F.array(*(x.cast("double") for x in features(c["value"], c["before"], c["behind"]))).alias("x")))
    score = lambda r: F.when(r["value"].startswith("-----BEGIN"), F.lit(1.0)).otherwise(forest.votes([r["x"][i] for i in range(len(FEATURES))]))
    return F.transform(rows, lambda r: F.struct(r["start"].alias("start"), r["value"].alias("value"), score(r).alias("score")))


def recall_by_kind(spark: SparkSession, rows: int = 6000) -> dict[str, float]:
    """Share of held-out findings judged a secret, for each kind of credential and look-alike: a third by the value's hash is held out."""
    labelled = labelled_findings(spark, rows)
    held = F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(3)) == 1
    forest = Forest.train(labelled.where(~held))
    found = labelled.where(held).select("kind", F.length("before").alias("from"), "value", findings(F.concat("before", "value", "behind"), forest).alias("f"))
    hit = F.exists("f", lambda f: (f["start"] == F.col("from")) & (f["value"] == F.col("value")) & (f["score"] >= ACCEPT))
    return {r[0]: r[1] for r in found.groupBy("kind").agg(F.avg(F.coalesce(hit, F.lit(False)).cast("int"))).collect()}


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate: doc_id, start, length, value_sha256, score, is_secret. Narrow, no shuffle."""
    forest = Forest.train(labelled if labelled is not None else labelled_findings(docs.sparkSession))
    rows = docs.select("doc_id", "text").where(F.col("text").rlike(CANDIDATE)).select("doc_id", F.explode(findings(F.col("text"), forest)).alias("f"))
    return rows.select("doc_id", F.col("f.start").alias("start"), F.length("f.value").cast("long").alias("length"), F.sha2("f.value", 256).alias("value_sha256"), F.col("f.score").alias("score"), (F.col("f.score") >= ACCEPT).alias("is_secret"))


def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """docs with each accepted secret in text replaced by MASK; all columns and rows stay."""
    forest = Forest.train(labelled if labelled is not None else labelled_findings(docs.sparkSession))
    text = F.col("text")
    hits, between = findings(text, forest), F.split(text, CANDIDATE, -1)
    parts = F.zip_with(F.slice(between, 1, F.size(between) - 1), hits, lambda gap, h: F.concat(gap, F.when(h["score"] >= ACCEPT, F.lit(MASK)).otherwise(h["value"])))
    return docs.withColumn("text", F.when(text.rlike(CANDIDATE), F.concat(F.array_join(parts, ""), F.element_at(between, -1))).otherwise(text))
