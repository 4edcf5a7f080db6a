"""Published sample words of the English (Porter2) stemmer."""
import pytest

from searchscore.functions.porter2 import stem

GOLDEN = {
    "consign": "consign", "consigned": "consign", "consigning": "consign",
    "consignment": "consign", "consist": "consist", "consisted": "consist",
    "consistency": "consist", "consistent": "consist", "consistently": "consist",
    "consisting": "consist", "consists": "consist", "consolation": "consol",
    "consolations": "consol", "consolatory": "consolatori", "console": "consol",
    "consoled": "consol", "consoles": "consol", "consolidate": "consolid",
    "consolidated": "consolid", "consolidating": "consolid", "consoling": "consol",
    "consolingly": "consol", "consols": "consol", "consonant": "conson",
    "consort": "consort", "consorted": "consort", "consorting": "consort",
    "conspicuous": "conspicu", "conspicuously": "conspicu", "conspiracy": "conspiraci",
    "conspirator": "conspir", "conspirators": "conspir", "conspire": "conspir",
    "conspired": "conspir", "conspiring": "conspir", "constable": "constabl",
    "constables": "constabl", "constance": "constanc", "constancy": "constanc",
    "constant": "constant", "knack": "knack", "knackeries": "knackeri", "kneel": "kneel",
    "knees": "knee", "caresses": "caress", "flies": "fli", "dies": "die", "mules": "mule",
    "denied": "deni", "died": "die", "agreed": "agre", "owned": "own", "humbled": "humbl",
    "sized": "size", "meeting": "meet", "stating": "state", "siezing": "siez",
    "itemization": "item", "sensational": "sensat", "traditional": "tradit",
    "reference": "refer", "colonizer": "colon", "plotted": "plot", "generously": "generous",
    "skies": "sky", "news": "news", "proceed": "proceed", "cries": "cri", "ties": "tie",
    "gaps": "gap", "gas": "gas", "kiwis": "kiwi", "by": "by", "say": "say",
}


@pytest.mark.parametrize("word,expected", sorted(GOLDEN.items()))
def test_stem(word, expected):
    assert stem(word) == expected


def test_stem_text_keeps_separators():
    from searchscore.operators.stemming import stem_text
    assert stem_text("running  shoes\x00metal colors, 2x4") == "run  shoe\x00metal color, 2x4"
    assert stem_text(None) is None
    assert stem_text("") == ""
