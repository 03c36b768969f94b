import pytest
from pyspark.sql import functions as F

from quillon.functions.english import english_terms, stem, terms
from quillon.functions.normalize import weighted_terms

# Words and their stems from the author's published sample vocabulary.
SAMPLE = """
consign:consign consigned:consign consigning:consign consignment:consign consist:consist consisted:consist consistency:consist
consistent:consist consistently:consist consolation:consol consolations:consol consolatory:consolatori console:consol
consoled:consol consolidate:consolid consolidating:consolid consolingly:consol consonant:conson conspicuous:conspicu
conspicuously:conspicu conspiracy:conspiraci conspirator:conspir conspirators:conspir conspire:conspir conspiring:conspir
constable:constabl constance:constanc constancy:constanc constant:constant knack:knack knackeries:knackeri knavish:knavish
kneaded:knead kneel:kneel knees:knee knightly:knight knitted:knit knitting:knit knives:knive knocker:knocker knopp:knopp
hoping:hope hopping:hop generally:general communication:communic relational:relat happy:happi say:say cry:cri by:by gas:gas
this:this ties:tie cries:cri
"""


@pytest.mark.parametrize("pair", SAMPLE.split())
def test_stems(pair):
    word, want = pair.split(":")
    assert stem(word) == want


def test_terms(spark):
    assert terms("The Companies' running of the 2nd Energies") == ["compani", "run", "2nd", "energi"]
    assert terms(None) == [] and terms("the of") == []
    d = spark.createDataFrame([("Running companies", None), (None, "x")], "a string, b string")
    assert [r[0] for r in d.select(english_terms(F.col("a"))).collect()] == [["run", "compani"], []]
    both = d.select(weighted_terms({"A": F.col("a"), "B": F.col("b")}, english=True).alias("t")).collect()
    assert [[tuple(x) for x in r["t"]] for r in both] == [[("run", "A"), ("compani", "A")], [("x", "B")]]
