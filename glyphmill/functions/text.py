"""Column functions on marked text: clusters, slots, segments, identity, comparison.

Everything but nfc() is a native expression. A slot is struct(base, vowel, dagesh, shin): the first vowel mark and the
last shin or sin dot of a cluster count, other marks are dropped.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..profile import BEGADKEFAT, DAGESH, HEBREW, HOLAM, LETTERS, LIGATURES, MARKS, QAMATS, QAMATS_QATAN, QUBUTS, SHIN_DOT, SIN_DOT, VAV, VOWELS, ScriptProfile


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition; the one text function that Spark lacks."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def normalize(text: Column) -> Column:
    """NFC, then each ligature as its two letters."""
    out = nfc(text)
    for one, two in LIGATURES.items():
        out = F.replace(out, F.lit(one), F.lit(two))
    return out


#: Presentation forms whose canonical composition is a letter with marks, and the ligatures.
_DECOMPOSED = {chr(c): unicodedata.normalize("NFC", chr(c)) for c in range(0xFB1D, 0xFB50) if unicodedata.normalize("NFC", chr(c)) != chr(c)} | LIGATURES


def decomposed(text: Column) -> Column:
    """normalize() as far as slots can tell: forms and ligatures as letters with marks. The order of marks, which NFC also sets, makes no difference to slots."""
    out = text
    for one, several in _DECOMPOSED.items():
        out = F.replace(out, F.lit(one), F.lit(several))
    return F.when(text.rlike("[" + "".join(_DECOMPOSED) + "]"), out).otherwise(text)


def strip(text: Column, profile: ScriptProfile = HEBREW, keep_cantillation: bool = False) -> Column:
    if keep_cantillation:
        return F.regexp_replace(text, f"[{MARKS}&&[^\\u0591-\\u05AF]]", "")
    return profile.strip(text)


def has_marks(text: Column, profile: ScriptProfile = HEBREW) -> Column:
    return profile.strip(text) != text


def has_letters(text: Column, profile: ScriptProfile = HEBREW) -> Column:
    return text.rlike(profile.letter)


def clusters(text: Column) -> Column:
    """array<string>: each base with the marks behind it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).[{MARKS}]*"), F.lit(0))


def mark_ratio(text: Column) -> Column:
    """Bases with a vowel per letter; 0 without letters."""
    letters = F.size(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]"), F.lit(0)))
    voweled = F.size(F.filter(clusters(text), lambda c: c.rlike(f"(?s)^.[{MARKS}]*[{VOWELS}]")))
    return F.when(letters > 0, voweled / letters).otherwise(0.0)


def slot(base: Column, vowel: Column, dagesh: Column, shin: Column) -> Column:
    return F.struct(base.alias("base"), vowel.alias("vowel"), dagesh.alias("dagesh"), shin.alias("shin"))


def slots(text: Column) -> Column:
    def one(c: Column) -> Column:
        marks = F.substring(c, F.lit(2), F.length(c))
        return slot(F.substring(c, 1, 1), F.regexp_extract(marks, f"[{VOWELS}]", 0), marks.contains(DAGESH), F.regexp_extract(marks, f"(?s).*([{SHIN_DOT}{SIN_DOT}])", 1))

    return F.transform(clusters(decomposed(text)), one)


def is_letter(s: Column) -> Column:
    return s["base"].rlike(f"^[{LETTERS}]$")


def letter_slots(text: Column) -> Column:
    return F.filter(slots(text), is_letter)


def compose(slots_: Column) -> Column:
    """Text of slots, with marks in canonical order: vowel, dagesh, dot."""
    return F.array_join(F.transform(slots_, lambda s: F.concat(s["base"], s["vowel"], F.when(s["dagesh"], DAGESH).otherwise(""), s["shin"])), "")


def canonical(text: Column) -> Column:
    return compose(slots(text))


def fix_mater_vowels(text: Column) -> Column:
    """Moves a vowel that stands before a bare vav onto it: qubuts becomes the vav's dagesh, holam its holam.

    A left-to-right fold, as a moved holam can move on. Text that doesn't change keeps all its marks.
    """
    t = decomposed(text)
    start = F.slice(slots(t), 1, 0)

    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        bare = (s["base"] == VAV) & (s["vowel"] == "") & ~s["dagesh"] & (s["shin"] == "")
        moves = (F.size(done) > 0) & bare & F.coalesce(last["vowel"].isin(QUBUTS, HOLAM), F.lit(False))
        cleared = F.array(slot(last["base"], F.lit(""), last["dagesh"], last["shin"]))
        moved = F.array(slot(s["base"], F.when(last["vowel"] == HOLAM, HOLAM).otherwise(s["vowel"]), last["vowel"] == QUBUTS, s["shin"]))
        return F.when(moves, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), cleared, moved)).otherwise(F.concat(done, F.array(s)))

    folded = F.aggregate(slots(t), start, step)
    return F.when(folded == slots(t), t).otherwise(compose(folded))


def words(text: Column, profile: ScriptProfile = HEBREW) -> Column:
    return F.regexp_extract_all(text, F.lit(profile.token), F.lit(0))


def segments(text: Column, profile: ScriptProfile = HEBREW) -> Column:
    """array of (piece, is_word); the pieces joined are the text."""
    return F.transform(F.regexp_extract_all(text, F.lit(profile.segment), F.lit(0)), lambda p: F.struct(p.alias("piece"), p.rlike("^" + profile.letter).alias("is_word")))


def is_acronym(word: Column) -> Column:
    """A double quote sign inside the stripped word before its last character, or a single one at its end."""
    body = HEBREW.strip(word)
    return F.substring(body, F.lit(1), F.greatest(F.length(body) - 1, F.lit(0))).rlike("[\"\\u05F4]") | F.right(body, F.lit(1)).isin("'", "׳")


def identity_diff(a: Column, b: Column) -> Column:
    """Null if equal, else (index of the first difference from 0, 20 characters around it on each side)."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: ~x.eqNullSafe(y))
    at = F.array_position(pairs, True) - 1
    around = lambda t: F.substring(t, F.greatest(at - 19, F.lit(1)).cast("int"), F.lit(41))
    return F.when(~a.eqNullSafe(b), F.struct(at.alias("at"), around(a).alias("a"), around(b).alias("b")))


def assert_identity(source: Column, output: Column, profile: ScriptProfile = HEBREW) -> Column:
    """output, or an error if stripping both doesn't give the same text."""
    return F.when(profile.strip(source).eqNullSafe(profile.strip(output)), output).otherwise(F.raise_error(F.concat(F.lit("identity broken: "), source)))


def _same(a: Column, b: Column, ignore_shin: bool, lenient: bool) -> Column:
    fold = lambda v: F.when(v == QAMATS_QATAN, QAMATS).otherwise(v) if lenient else v
    out = (a["base"] == b["base"]) & (fold(a["vowel"]) == fold(b["vowel"]))
    dagesh = a["dagesh"] == b["dagesh"]
    out = out & (dagesh | F.lit(BEGADKEFAT).contains(a["base"]) if lenient else dagesh)
    return out if ignore_shin else out & (a["shin"] == b["shin"])


def word_matches(a: Column, b: Column, ignore_shin: bool = False, lenient: bool = False) -> Column:
    x, y = slots(a), slots(b)
    return (F.size(x) == F.size(y)) & F.forall(F.zip_with(x, y, lambda s, t: F.coalesce(_same(s, t, ignore_shin, lenient), F.lit(False))), lambda ok: ok)


def char_errors(gold: Column, predicted: Column) -> Column:
    """struct(errors, slots) by vowel, dagesh and dot; where the lengths differ, all slots of the longer one are wrong."""
    x, y = slots(gold), slots(predicted)
    marks = lambda s: F.struct(s["vowel"], s["dagesh"], s["shin"])
    wrong = F.size(F.filter(F.zip_with(x, y, lambda s, t: marks(s) == marks(t)), lambda ok: ~ok))
    most = F.greatest(F.size(x), F.size(y))
    return F.struct(F.when(F.size(x) == F.size(y), wrong).otherwise(most).alias("errors"), most.alias("slots"))


def char_labels(text: Column, classes: list[str], ignore: int = -100) -> Column:
    """array of (base, niqqud class, dot class). A class is a letter's vowel and dagesh; unknown ones and other characters are ignored."""
    def one(s: Column) -> Column:
        key = F.concat(s["vowel"], F.when(s["dagesh"], DAGESH).otherwise(""))
        found = F.array_position(F.array(*map(F.lit, classes)), key).cast("int") - 1
        dot = F.when(s["base"] != "ש", ignore).otherwise(F.when(s["shin"] == SIN_DOT, 1).otherwise(0))
        return F.struct(s["base"].alias("base"), F.when(is_letter(s) & (found >= 0), found).otherwise(ignore).alias("niqqud"), F.when(is_letter(s), dot).otherwise(ignore).alias("dot"))

    return F.transform(slots(text), one)


def apply_labels(labels: Column, classes: list[str]) -> Column:
    """The inverse of char_labels(), then vowels to their vav."""
    known = F.array(*map(F.lit, classes))

    def one(r: Column) -> Column:
        marks = F.when(r["niqqud"] >= 0, F.element_at(known, r["niqqud"] + 1)).otherwise("")
        return slot(r["base"], F.replace(marks, F.lit(DAGESH), F.lit("")), marks.contains(DAGESH), F.when(r["dot"] == 0, SHIN_DOT).when(r["dot"] == 1, SIN_DOT).otherwise(""))

    return fix_mater_vowels(compose(F.transform(labels, one)))


def model_chunks(text: Column, size: int = 1800) -> Column:
    """Pieces of at most `size` characters, cut behind the last space that fits; joined they are the text."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size - 1}}}(?: |$)|.{{1,{size}}}"), F.lit(0))
    return pieces


def encode_chars(text: Column, vocabulary: Column, first: int, last: int, unknown: int) -> Column:
    """first, the id of each character (unknown where the map lacks it), last."""
    return F.concat(F.array(F.lit(first)), F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.coalesce(vocabulary[c], F.lit(unknown))), F.array(F.lit(last)))
