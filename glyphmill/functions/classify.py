"""Layers, names, construct forms and licences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profile import HEBREW, PATAH, TAV, TSERE, YOD, ScriptProfile
from .text import letter_slots, words

# Function words of the second language, words before names, names, and common construct forms.
ARAMAIC = "מאי האי הכי הכא התם ליה להו לן לך מילתא טעמא קא דקא אמאי אלמא איכא ליכא מנא תנן תניא גמרא אביי רבא אמרי וכו מידי נמי הוה דהא אלא פשיטא תיובתא שמעת מינה קמ בעי איבעיא אדרבה בשלמא לימא מסתברא הדר אתא עלמא מילי".split()
NAME_TRIGGERS = "רבי רב רבן רבנו בן בר מר אבא שמעון מרן הרב ורבי ורב דרבי דרב".split()
NAMES = "אליעזר יהושע עקיבא מאיר יהודה יוסי שמעון גמליאל אלעזר ישמעאל טרפון חנינא יוחנן אביי רבא אשי הונא חסדא נחמן ששת פפא זירא הלל שמאי אברהם יצחק יעקב משה אהרן דוד שלמה שמואל ירמיהו ישעיהו יחזקאל נחמיה עזרא אסתר מרדכי רחל לאה שרה רבקה מרים יוסף בנימין ראובן לוי".split()
CONSTRUCT = "בית בן בת כל אנשי שם דבר יד פי אל ערב בני בנות ראש עין אם אב דם חצי".split()
ARAMAIC_SHARE = 0.08


def marker_share(words_: Column, markers: list[str], patterns: str | None = None) -> Column:
    """Share of words that are markers or match the patterns; 0 without words."""
    known = F.array(*map(F.lit, markers))
    hit = lambda w: F.array_contains(known, w) | w.rlike(patterns) if patterns else F.array_contains(known, w)
    return F.when(F.size(words_) > 0, F.size(F.filter(words_, hit)) / F.size(words_)).otherwise(0.0)


def aramaic_score(text: Column) -> Column:
    return marker_share(F.transform(words(text), HEBREW.strip), ARAMAIC, "^ד[א-ת]{2,}$|ייהו$")


def is_aramaic(text: Column, least: float = ARAMAIC_SHARE) -> Column:
    return aramaic_score(text) >= least


def layer(source: Column, declared: Column, text: Column) -> Column:
    """The declared layer, but by sentence where a source mixes two languages."""
    return F.when(source == "talmud", F.when(is_aramaic(text), "aramaic").otherwise("mishnaic")).otherwise(declared)


def is_construct(word: Column) -> Column:
    s = letter_slots(word)
    last, prev = F.element_at(s, -1), F.element_at(s, -2)
    ending = ((last["base"] == YOD) & (prev["vowel"] == TSERE)) | ((last["base"] == TAV) & (last["vowel"] == PATAH))
    return HEBREW.strip(word).isin(CONSTRUCT) | F.when(F.size(s) >= 2, ending).otherwise(False)


def name_flags(skeletons: Column, names: list[str] | Column | None = None, triggers: list[str] | None = None) -> Column:
    """array<boolean>: in the gazetteer, or behind a trigger without being one."""
    gazetteer = names if isinstance(names, Column) else F.array(*map(F.lit, names or NAMES))
    before = F.array(*map(F.lit, triggers or NAME_TRIGGERS))
    return F.transform(skeletons, lambda w, i: F.array_contains(gazetteer, w) | ((i > 0) & F.array_contains(before, F.element_at(skeletons, F.greatest(i, F.lit(1)))) & ~F.array_contains(before, w)))


def construct_flags(words_: Column) -> Column:
    """array<boolean>: a construct form with a word behind it."""
    return F.transform(words_, lambda w, i: (i + 1 < F.size(words_)) & is_construct(w))


def license_verdict(license_: Column) -> Column:
    low = F.lower(F.trim(license_))
    return F.when(low.isNull() | low.isin("", "unknown", "none"), "unknown").when(low.contains("-nc") | low.contains("noncommercial") | low.contains("non-commercial"), "noncommercial").otherwise("ok")


def commercial_ok(license_: Column) -> Column:
    return license_verdict(license_) == "ok"


def skeletons(text: Column, profile: ScriptProfile) -> Column:
    return F.transform(words(text, profile), profile.strip)
