"""Random tokens in the forms that secrets are written in."""

import random
import string

import pytest

from caloris.llm import secret_scan

ALNUM = string.ascii_letters + string.digits
DRAWN = random.Random(11)
KEY, URL_KEY, GHP = ("".join(DRAWN.choices(symbols, k=n)) for symbols, n in ((ALNUM + "+/", 40), (ALNUM + "-_", 43), (ALNUM, 36)))
FORMS = {
    f"AWS_SECRET_ACCESS_KEY={KEY}": KEY,
    f"client_key={KEY}": KEY,
    f"AUTH=ghp_{GHP}": f"ghp_{GHP}",
    f"https://files.example.com/a?sig={GHP}&v=1": GHP,
    f"client_key={KEY}==": f"{KEY}==",
    f"https://example.com/hooks/my-team/{URL_KEY}": URL_KEY,
    f"blob_name-1/{URL_KEY}/end": URL_KEY,
}


@pytest.fixture(scope="module")
def found(spark):
    texts = [f"see {t} there" for t in FORMS]
    rows = secret_scan.scan(spark.createDataFrame([(t,) for t in [*texts, "see some_very-long/path_of-words/and_2-more=words_and-so/on_for-3-times there"]], "text string")).collect()
    return {r.text: r for r in rows}


@pytest.mark.parametrize("form", FORMS)
def test_forms(found, form):
    text = f"see {form} there"
    spans = [(s.start, s.end, s.match) for s in found[text].spans]
    at = text.index(FORMS[form])
    assert any(a <= at and at + len(FORMS[form]) <= b and text[a:b] == m for a, b, m in spans), spans


def test_paths_of_words_are_no_secrets(found):
    assert [r.spans for t, r in found.items() if "path_of" in t] == [[]]
