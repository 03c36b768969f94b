"""Subject areas of documents."""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from statistics import median

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.common import cut
from quillon.llm import terms

#: Words of a usual sentence; a stretch without punctuation of more than ``LONGEST`` is cut into about that many.
USUAL, LONGEST = 11, 26
#: Shares that the calibration tries around the one asked for, and how many labels the prior counts for.
SPREAD, PULLS = 0.08, (4000.0, 400.0, 40.0)

_TAG = re.compile(r"</?[a-zA-Z!][^<>]*>")
_BLANK = re.compile(r"[^\S\n]+")
_END = re.compile(r"(?<=[.!?])[\"')\]]*\s+|\n+")
_WORD = re.compile(r"\w")
_TOKEN = re.compile(r"\S+")
_MOJIBAKE = re.compile("[ÂÃ][\x80-¿]")

Terms = tuple[tuple[str, str, float], ...]


@dataclass(frozen=True)
class Lexicon:
    """A compiled vocabulary: subjects, (subject number, weight) of each term, and the automaton over all phrases."""

    subjects: tuple[str, ...]
    of: tuple[tuple[int, float], ...]
    automaton: object

    @property
    def passing(self) -> int:
        """The number that stands for a remark in passing; a standing notice has the next one."""
        return len(self.of)


@lru_cache(maxsize=4)
def lexicon(vocabulary: Terms) -> Lexicon:
    """The automaton of a vocabulary; built once per worker."""
    import ahocorasick

    subjects = tuple(sorted({s for s, _, _ in vocabulary}))
    phrases: dict[str, list[tuple[int, bool, bool]]] = {}
    for i, (_, term, _) in enumerate(vocabulary):
        t = term.strip("*")
        shape = (i, term.startswith("*"), term.endswith("*"))
        phrases.setdefault(t, []).append(shape)
        if t.endswith("y") and t[-2:-1] not in "aeiou" and not shape[2]:
            phrases.setdefault(t[:-1] + "ies", []).append(shape)
    for number, group in ((len(vocabulary), terms.PASSING), (len(vocabulary) + 1, terms.NOTICES)):
        for t in group:
            phrases.setdefault(t, []).append((number, False, True))
    a = ahocorasick.Automaton()
    for t, shapes in phrases.items():
        a.add_word(t, (len(t), tuple(shapes)))
    a.make_automaton()
    return Lexicon(subjects, tuple((subjects.index(s), w) for s, _, w in vocabulary), a)


def cleaned(text: str) -> str:
    """Lower case without markup, with UTF-8 read as Latin-1 put right and blanks single."""
    if _MOJIBAKE.search(text):
        text = _MOJIBAKE.sub(lambda m: _repair(m[0]), text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    return _BLANK.sub(" ", text).lower()


def _repair(pair: str) -> str:
    try:
        return pair.encode("latin-1").decode("utf-8")
    except UnicodeError:
        return pair


_ENDINGS = frozenset(terms.ENDINGS)


def _found(text: str, lex: Lexicon) -> list[tuple[int, list[int]]]:
    """(place, numbers) of the phrases in a cleaned text, each a whole word or words; those inside a longer one are left out."""
    raw, length = [], len(text)
    for end, (size, shapes) in lex.automaton.iter(text):
        start, after = end - size + 1, end + 1
        inside = start > 0 and text[start - 1].isalnum()
        whole = True
        if after < length and text[after].isalnum():  # the word goes on; an apostrophe ends it
            stop = after + 1
            while stop < length and stop - after < 4 and text[stop].isalnum():
                stop += 1
            whole = text[after:stop] in _ENDINGS
        ids = [i for i, left, right in shapes if (whole or right) and (left or not inside)]
        if ids:
            raw.append((start, -after, ids))
    raw.sort(key=lambda h: h[:2])
    out: list[tuple[int, list[int]]] = []
    reach = -1
    for start, minus, ids in raw:
        if -minus > reach:  # else it lies inside a longer one that began before
            out.append((start, ids))
            reach = -minus
        elif out and out[-1][0] == start and -minus == reach:
            out[-1] = (start, out[-1][1] + ids)
    return [(start, _one_each(ids, lex)) for start, ids in out]


def _one_each(ids: list[int], lex: Lexicon) -> list[int]:
    """The strongest term of each subject among those that one place matches (two terms may have an inflected form in common)."""
    if len(ids) == 1:
        return ids
    best: dict[int, int] = {}
    for i in sorted(ids):
        kind = lex.of[i][0] if i < lex.passing else -1 - i
        if kind not in best or (i < lex.passing and lex.of[i][1] > lex.of[best[kind]][1]):
            best[kind] = i
    return list(best.values())


def sentence_hits(text: str | None, lex: Lexicon) -> list[list[int]]:
    """For each sentence of the text, standing notices aside, the numbers of the phrases in it."""
    out: list[list[int]] = []
    if not text:
        return out
    text = cleaned(text)
    found = _found(text, lex)
    borders = [m.span() for m in _END.finditer(text)]
    borders.append((len(text), len(text)))
    at, begin, notice = 0, 0, lex.passing + 1
    for stop, after in borders:
        hits = []
        while at < len(found) and found[at][0] < stop:
            hits.append(found[at])
            at += 1
        if any(notice in ids for _, ids in hits) or not _WORD.search(text, begin, stop):
            pass
        elif text.count(" ", begin, stop) < LONGEST:
            out.append([i for _, ids in hits for i in ids])
        else:
            starts = [m.start() for m in _TOKEN.finditer(text, begin, stop)]
            out.extend(_run_on([(bisect_right(starts, place) - 1, ids) for place, ids in hits], len(starts), lex))
        begin = after
    return out


def _run_on(hits: list[tuple[int, list[int]]], words: int, lex: Lexicon) -> list[list[int]]:
    """Parts of a long stretch without punctuation.

    A strong term opens a new part where it is of another subject than the strong term before, or a usual sentence after
    the last opening; so does a remark in passing. A part of several sentences' length is cut into about equal ones,
    before a strong term where one is near.
    """
    opens, asides, strong, last, since = [0], set(), [], None, -USUAL
    for word, ids in hits:
        subject = next((lex.of[i][0] for i in ids if i < lex.passing and lex.of[i][1] >= terms.STRONG), None)
        aside = lex.passing in ids
        if subject is not None:
            strong.append(word)
        if aside or (subject is not None and (word - since >= USUAL or (subject != last and last != "aside"))):
            place = 0 if opens == [0] and word <= USUAL // 2 else word
            opens.append(place)
            if aside:
                asides.add(place)
            last, since = ("aside" if aside else subject), word
    opens = sorted(set(opens))
    cuts: list[int] = []
    for start, stop in zip(opens, [*opens[1:], words], strict=True):
        n = max(1, round((stop - start) / USUAL))
        cuts.append(start)
        for k in range(1, n):
            even = start + k * (stop - start) // n
            near = [w for w in strong if start not in asides and cuts[-1] < w < stop and abs(w - even) <= USUAL // 2]
            cuts.append(min(near, key=lambda w: abs(w - even)) if near else max(even, cuts[-1] + 1))
    parts: list[list[int]] = [[] for _ in cuts]
    for word, ids in hits:
        parts[bisect_right(cuts, word) - 1].extend(ids)
    return parts


def _hits(batches: Iterator[pa.RecordBatch], vocabulary: Terms) -> Iterator[pa.RecordBatch]:
    kind, lex = pa.list_(pa.list_(pa.int16())), lexicon(vocabulary)
    for b in batches:
        rows = [sentence_hits(t, lex) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], names=["doc_id", "hits"])


def sentence_subjects(hits: list[int], weight: list[float], lex: Lexicon) -> list[int]:
    """The subject that a sentence is about, if any: the best sum of term weights, if it reaches 1."""
    if not hits or lex.passing in hits:
        return []
    score: dict[int, float] = {}
    for i in set(hits):
        s = lex.of[i][0]
        score[s] = score.get(s, 0.0) + weight[i]
    best = max(score.values())
    return [s for s, v in score.items() if v == best and v >= 1.0]


def term_weights(frequency: dict[int, int], documents: int, lex: Lexicon) -> list[float]:
    """Weight of each term: its own weight times its rarity among all documents, 1 for a usual term.

    Usual is the median rarity of the terms that occur, so equal shares of the documents give equal weights at any
    number of documents; a term that doesn't occur has the greatest weight.
    """
    idf = [-math.log(frequency[i] / documents) if frequency.get(i) else math.inf for i in range(len(lex.of))]
    usual = median([v for v in idf if v < math.inf] or [0.0]) or 1.0
    return [w * min(1.5, max(0.5, v / usual)) for (_, w), v in zip(lex.of, idf, strict=True)]


def _shares(batches: Iterator[pa.RecordBatch], weight: list[float], vocabulary: Terms) -> Iterator[pa.RecordBatch]:
    lex = lexicon(vocabulary)
    known: dict[bytes, list[int]] = {}  # sentences with the same phrases have the same subject
    for b in batches:
        ids, subjects, shares, counts = [], [], [], []
        outer, inner = b.column(1), b.column(1).values
        first, cuts = outer.offsets.to_pylist(), inner.offsets.to_pylist()
        data = inner.values.to_numpy(zero_copy_only=False).astype(np.int16).tobytes()
        for d, start, stop in zip(b.column(0).to_pylist(), first, first[1:], strict=False):
            about: dict[int, int] = {}
            for k in range(start, stop):
                key = data[2 * cuts[k] : 2 * cuts[k + 1]]
                if (found := known.get(key)) is None:
                    found = known[key] = sentence_subjects(np.frombuffer(key, np.int16).tolist(), weight, lex)
                for s in found:
                    about[s] = about.get(s, 0) + 1
            for s, n in about.items():
                ids.append(d)
                subjects.append(lex.subjects[s])
                shares.append(n / (stop - start))
                counts.append(stop - start)
        if len(known) > 1_000_000:
            known.clear()
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(subjects, pa.string()), pa.array(shares, pa.float64()), pa.array(counts, pa.int32())],
            names=["doc_id", "subject", "share", "sentences"],
        )


def _errors(points: Sequence[tuple[float, bool]], steps: np.ndarray) -> np.ndarray:
    """Wrong decisions on labelled shares at each threshold."""
    if not len(points):
        return np.zeros(len(steps))
    share, yes = np.array([p[0] for p in points]), np.array([p[1] for p in points])
    return ((share[None, :] >= steps[:, None] - 1e-9) != yes[None, :]).sum(axis=1).astype(float)


def fitted(points: Sequence[tuple[str, float, bool]], subjects: Sequence[str], prior: float, pull: float) -> dict[str, float]:
    """Share threshold per subject.

    It has the fewest own errors plus the error rate over all subjects times ``pull``, plus a fixed price of the distance
    from ``prior``: with few labels a subject follows all, and all follow the prior, with no step between.
    """
    steps = np.round(np.linspace(prior - SPREAD, prior + SPREAD, 17), 4)
    price = np.abs(steps - prior) / SPREAD
    whole = _errors([p[1:] for p in points], steps) + price
    shared = pull * whole / (len(points) + 1)
    own = {s: _errors([p[1:] for p in points if p[0] == s], steps) for s in subjects}
    return {s: float(min(zip(e + shared + price, price, steps, strict=True))[2]) for s, e in own.items()}


def calibrated(points: Sequence[tuple[str, float, bool]], subjects: Sequence[str], prior: float) -> dict[str, float]:
    """:func:`fitted` with the pull that makes the fewest errors in fivefold cross-validation (the strongest of equal ones)."""
    points = sorted(points)

    def errors(pull: float) -> int:
        wrong = 0
        for k in range(5):
            limit = fitted([p for i, p in enumerate(points) if i % 5 != k], subjects, prior, pull)
            wrong += sum((share >= limit[s] - 1e-9) != yes for s, share, yes in points[k::5])
        return wrong

    return fitted(points, subjects, prior, min(PULLS, key=lambda pull: (errors(pull), -pull)))


def vocabulary_of(areas: Sequence[tuple[str, str | None]] | None, vocabulary: Terms) -> Terms:
    """The terms of the subjects in ``areas``, pairs of a subject and what it covers.

    A subject without terms takes the words of what it covers, as plain terms.
    """
    if areas is None:
        return vocabulary
    wanted = {s.strip().lower(): covers or "" for s, covers in areas if s and s.strip()}
    named = {s for s, _, _ in vocabulary}
    made = [(s, w, terms.PLAIN) for s in sorted(wanted) if s not in named for w in sorted(set(re.findall(r"\w{4,}", f"{s} {wanted[s]}".lower())))]
    return tuple(t for t in vocabulary if t[0] in wanted) + tuple(made)


def subjects_of(
    documents: DataFrame, labels: DataFrame, *, doc_id: Column, text: Column, label_id: Column, label_subject: Column,
    areas: DataFrame | None = None, area: Column | None = None, covers: Column | None = None, vocabulary: Terms = terms.VOCABULARY,
    share: float = 0.25, max_labelled: int = 20_000, max_areas: int = 1000,
) -> DataFrame:
    """(doc_id, subject, share, sentences): every subject that enough of a document's sentences are about.

    Method: one automaton finds all weighted terms of all subjects in the whole text; a sentence is about the
    subject with the greatest sum of its terms' weights (strength of the term times rarity among all documents), if that
    sum reaches 1, so an ambiguous term alone decides nothing; a
    document's score is the share of its sentences, which normalises by length, standing notices not counted,
    remarks in passing counted as sentences about nothing. Stretches of more than ``LONGEST`` words without punctuation
    are cut at the terms that open a sentence. Thresholds of the share start from ``share`` and
    are calibrated on hand-labelled documents, with cross-validation.

    ``vocabulary`` has (subject, term, weight) as in :mod:`quillon.llm.terms`; ``areas`` (at most ``max_areas`` rows) names
    the subjects wanted, and one that the vocabulary lacks takes the words of ``covers`` as its terms.

    Scale: texts are read by one Arrow pass without a shuffle; its result, a few numbers a sentence, is
    checkpointed in the shared folder and used for both the term frequencies (one row per term, at most
    the terms of the tables) and the assignment. Calibration reads the labelled documents whose hash is below a
    threshold, about ``max_labelled`` of them (a documented bound); everything else covers all documents.

    Defined cases: a null or empty text has no subject; repeated ids are judged row by row; without labels the
    thresholds stay at ``share``; other columns are not used.
    """
    wanted = None if areas is None else [tuple(r) for r in areas.select(F.lower(area), covers).limit(max_areas).collect()]
    words = vocabulary_of(wanted, vocabulary)
    lex = lexicon(words)
    narrow = documents.select(doc_id.cast("bigint").alias("doc_id"), text.cast("string").alias("text"))
    hits = cut(narrow.mapInArrow(lambda it: _hits(it, words), "doc_id bigint, hits array<array<smallint>>"))
    counted = hits.select(F.explode(F.array_distinct(F.flatten("hits"))).alias("t")).where(F.col("t") < len(lex.of)).groupBy("t").count().collect()
    weight = term_weights({r["t"]: r["count"] for r in counted}, hits.count(), lex)
    shares_of = lambda df: df.mapInArrow(lambda it: _shares(it, weight, words), "doc_id bigint, subject string, share double, sentences int")
    given = labels.select(label_id.cast("bigint").alias("doc_id"), F.lower(F.trim(label_subject)).alias("subject")).where("doc_id is not null").distinct()
    some = given.select("doc_id").distinct()
    part = min(1.0, max_labelled / max(1, some.count()))
    below = lambda df: df.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(part * (1 << 30)))
    judged = shares_of(hits.join(below(some), "doc_id", "left_semi")).join(below(given).withColumn("yes", F.lit(True)), ["doc_id", "subject"], "left")
    points = [(r["subject"], r["share"], bool(r["yes"])) for r in judged.select("subject", "share", "yes").collect()]
    limit = calibrated(points, lex.subjects, share)
    cutoff = F.create_map(*[F.lit(x) for kv in limit.items() for x in kv])[F.col("subject")] if limit else F.lit(share)
    return shares_of(hits).where(F.col("share") >= cutoff - 1e-9)
