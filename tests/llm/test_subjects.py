import pytest

pytest.importorskip("quillon.llm")
from quillon.llm import subjects as sj  # noqa: E402

from quillon.llm import terms  # noqa: E402
from plain_sentences import SENTENCES  # noqa: E402

LEX = sj.lexicon(terms.VOCABULARY)
W = [w for _, w in LEX.of]
#: Weights where no term occurs in the corpus: each is as rare as can be.
RARE = sj.term_weights({}, 1, LEX)


def about(text, weight=W):
    hits = sj.sentence_hits(text, LEX)
    got = {}
    for h in hits:
        for s in sj.sentence_subjects(h, weight, LEX):
            got[LEX.subjects[s]] = got.get(LEX.subjects[s], 0) + 1
    return got, len(hits)


def test_plain_sentences_get_their_subject_and_others_stay_silent():
    """The sentences share no phrase with the corpus; they and the vocabulary have one author, so this is no blind test."""
    for weight in (W, RARE):
        right = [about(x, weight)[0] == {s: 1} for s, xs in SENTENCES.items() if s for x in xs]
        silent = [about(x, weight)[0] == {} for x in SENTENCES[""]]
        assert len(right) == 195 and sum(right) >= 0.9 * len(right), sum(right)
        assert sum(silent) >= 0.95 * len(silent), sum(silent)


def test_ambiguous_words_decide_nothing_alone():
    assert about("Escape the cape! The plots thicken in the novel. Containers of soup. Birds sing.", RARE) == ({}, 4)
    assert about("The banker was impatient with the wheatear and the farmerless landscape.", RARE)[0] == {"banking": 1}, "whole words only"
    assert about("Utilities and property: two words in company names.", RARE)[0] == {}


def test_sentences():
    assert about("The grid operator shut a coal unit early. Further details were not given.") == ({"energy": 1}, 2)
    assert about("Der Versorger legte ein Kohlekraftwerk still. El banco central elevó su previsión de inflación.") == ({"energy": 1, "monetary": 1}, 2)
    assert about("In other news, the league won 3 matches in a row. The toy seller saw returns climb.") == ({"retail": 1}, 2)
    assert about("Shares of Jorurd Foods Bancorp (JFB) closed at 3.1 in mixed trading.") == ({}, 1)
    assert about("<p>The toy seller saw returns climb.</p>\n*** END OF NOTICE ***\n&copy; All rights reserved.") == ({"retail": 1}, 1)
    assert about("Der BÃ¼rovermieter klagte Ã¼ber Leerstand.") == ({"property": 1}, 1)
    assert about("The utiloty pumped 5 thousand barrels a day with carbon permits at a record.") == ({"energy": 1}, 1), "other terms stand in for a misspelt one"
    assert about("1 < 2 and 3 > 2, said the judge. <img alt='" + "x" * 500 + " the judge'>") == ({"law": 1}, 1)


def test_missing_punctuation():
    text = "the soybean crop planted drought tolerant hybrids meanwhile the grid operator pumped 712 thousand barrels a day solar panels now cover the roofs of 513 depots in other news the league won 3 matches in a row the board of x meets again in may"
    got, n = about(text)
    assert got == {"agrifood": 1, "energy": 2} and n == 5


def test_areas_choose_and_extend_the_vocabulary():
    words = sj.vocabulary_of([("Law", None), ("chess", "Chess openings and endgames"), (None, "x"), (" ", "y")], terms.VOCABULARY)
    assert {s for s, _, _ in words} == {"law", "chess"}
    lex = sj.lexicon(words)
    hits = sj.sentence_hits("Endgames are hard. The judge ruled. The barley is ripe.", lex)
    assert [[lex.subjects[s] for s in sj.sentence_subjects(h, sj.term_weights({}, 1, lex), lex)] for h in hits] == [["chess"], ["law"], []]
    assert sj.vocabulary_of(None, terms.VOCABULARY) is terms.VOCABULARY and sj.vocabulary_of([], terms.VOCABULARY) == ()


def test_void_and_long():
    assert about(None) == ({}, 0) and about("") == ({}, 0) and about("??? -") == ({}, 0)
    got, n = about("The toy seller saw returns climb. " * 20_000)
    assert got == {"retail": 20_000} and n == 20_000


def test_calibration_keeps_the_prior_without_labels_and_follows_many():
    assert set(sj.calibrated([], ("law", "sport"), 0.25).values()) == {0.25}
    points = [("law", s / 100, s >= 21) for s in range(0, 100)] * 10
    got = sj.calibrated(points, ("law", "sport"), 0.25)
    assert 0.2 < got["law"] <= 0.21 and 0.2 < got["sport"] <= 0.25


def test_calibration_has_no_step_at_a_number_of_labels():
    others = [("energy", s / 1000, s >= 290) for s in range(1000)] * 3
    limits = [sj.fitted(others + [("law", s / n, s >= 0.2 * n) for s in range(n)], ("energy", "law"), 0.25, 400.0)["law"] for n in (5, 20, 80, 390, 410, 1500)]
    assert limits == sorted(limits, reverse=True) and abs(limits[3] - limits[4]) < 0.011


def test_equal_shares_give_equal_weights_at_every_size():
    shares = {i: 1 + i % 40 for i in range(0, len(LEX.of), 2)}
    small, large = (sj.term_weights({i: n * k for i, n in shares.items()}, 1000 * k, LEX) for k in (1, 1000))
    assert max(abs(x - y) for x, y in zip(small, large, strict=True)) < 1e-9


def test_operator(spark):
    docs = [(1, "The toy seller saw returns climb. The league named a new head coach. A. B. C. D. E.", "x"), (1, "Nothing here.", "x"), (2, None, "x"), (3, "The lender wrote off card balances.", "x"), (3, "The lender wrote off card balances.", "x"), (None, "The lender lost.", "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, subject string")
    lab = spark.createDataFrame([(3, "Banking"), (3, None), (None, "law")], "doc_id long, subject string")
    args = dict(doc_id=d["doc_id"], text=d["text"], label_id=lab["doc_id"], label_subject=lab["subject"])
    got = [(r["doc_id"], r["subject"]) for r in sj.subjects_of(d, lab, **args).collect()]
    assert sorted(got, key=str) == [(3, "banking"), (3, "banking"), (None, "banking")]
    areas = spark.createDataFrame([("sport", None)], "subject string, covers string")
    assert [r["subject"] for r in sj.subjects_of(d, lab, **args, areas=areas, area=areas["subject"], covers=areas["covers"]).collect()] == []
    e = spark.createDataFrame([], d.schema)
    assert sj.subjects_of(e, lab, **(args | {"doc_id": e["doc_id"], "text": e["text"]})).count() == 0


def test_labelled_documents():
    """Agreement with the hand-labelled sample, a few labels of which are wrong; no weight or threshold is fitted on it here."""
    import os

    import duckdb

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    if not os.path.exists(f"{sf}/subject_label.parquet"):
        pytest.skip("no test tables")
    rows = duckdb.sql(f"select d.doc_id, d.text, (select list(subject) from '{sf}/subject_label.parquet' l where l.doc_id = d.doc_id) from '{sf}/documents.parquet' d where doc_id in (select doc_id from '{sf}/subject_label.parquet')").fetchall()
    right = total = 0
    for _, text, labels in rows:
        got, n = about(text)
        mine = {s for s, k in got.items() if n and k / n >= 0.25}
        right += mine == set(labels) - {None}
        total += 1
    assert right >= 0.93 * total
