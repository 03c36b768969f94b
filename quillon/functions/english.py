"""English search terms: stop words and the second Porter stemmer, as published by its author."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that carry no meaning in a search.
STOP_WORDS = frozenset(
    """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself
    they them their theirs themselves what which who whom this that these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under again further then once here there when where why
    how all any both each few more most other some such no nor not only own same so than too very s t can will just don should
    now""".split()
)
# Words with stems of their own, and suffixes with what replaces them in the region after the first or second syllable.
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli",
    "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURAL = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
STEP_2 = {
    "ization": "ize", "ational": "ate", "ousness": "ous", "iveness": "ive", "fulness": "ful", "tional": "tion", "lessli": "less", "biliti": "ble", "entli": "ent",
    "ation": "ate", "alism": "al", "aliti": "al", "fulli": "ful", "ousli": "ous", "iviti": "ive", "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate",
    "alli": "al", "bli": "ble", "ogi": "og", "li": "",
}
STEP_3 = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ative": "", "ical": "ic", "ness": "", "ful": ""}
STEP_4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic")

_REGION = re.compile(r"[^aeiouy]*[aeiouy]+[^aeiouy](.*)", re.S)
_DOUBLE = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")


def _after(word: str, start: int = 0) -> int:
    """Where the part after the first consonant that follows a vowel begins."""
    m = _REGION.fullmatch(word[start:])
    return start + m.start(1) if m else len(word)


def _short(word: str, r1: int) -> bool:
    return r1 >= len(word) and bool(re.search(r"(?:^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$", word))


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """The stem of a lower-case English word."""
    if len(word) <= 2:
        return word
    if word in EXCEPTIONS:
        return EXCEPTIONS[word]
    w = re.sub(r"^y|(?<=[aeiouy])y", "Y", word.lstrip("'"))
    special = re.match(r"gener|commun|arsen", w)
    r1 = special.end() if special else _after(w)
    r2 = _after(w, r1)
    w = re.sub(r"'s?'?$", "", w)
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and re.search(r"[aeiouy].+s$", w):
        w = w[:-1]
    if w in KEPT_AFTER_PLURAL:
        return w
    if m := re.search(r"(eed|eedly)$", w):
        w = w[: m.start()] + "ee" if m.start() >= r1 else w
    elif (m := re.search(r"(ingly|edly|ing|ed)$", w)) and re.search(r"[aeiouy]", w[: m.start()]):
        w = w[: m.start()]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif w.endswith(_DOUBLE):
            w = w[:-1]
        elif _short(w, r1):
            w += "e"
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in "aeiouy":
        w = w[:-1] + "i"
    for table, region in ((STEP_2, r1), (STEP_3, r1)):
        end = next((e for e in table if w.endswith(e)), None)
        if end and len(w) - len(end) >= region:
            head = w[: len(w) - len(end)]
            allowed = {"ogi": head.endswith("l"), "li": head[-1:] in tuple("cdeghkmnrt"), "ative": len(head) >= r2}.get(end, True)
            w = head + table[end] if allowed else w
    end = next((e for e in STEP_4 if w.endswith(e)), None)
    if end and len(w) - len(end) >= r2 and (end != "ion" or w[:-3].endswith(("s", "t"))):
        w = w[: len(w) - len(end)]
    if w.endswith("e") and (len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short(w[:-1], 0 if len(w) < 2 else len(w)))):
        w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.replace("Y", "y")


def terms(text: str | None) -> list[str]:
    """Stems of a text's words in order, without stop words."""
    return [stem(w) for w in re.findall(r"[a-z0-9]+", (text or "").lower()) if w not in STOP_WORDS]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _terms(texts: pd.Series) -> pd.Series:
    return texts.map(terms)


def english_terms(c: Column) -> Column:
    """Array of the stems of a text's words, without stop words; empty for null."""
    return _terms(c.cast("string"))
