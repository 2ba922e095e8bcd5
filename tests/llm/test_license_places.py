import pytest

from fleetscope.llm.licenses import TEMPLATES, scan_licenses

from .conftest import documents


@pytest.mark.parametrize("named", [False, True])
def test_every_place_of_every_license_is_returned(shipped, named):
    mit, cc = TEMPLATES["mit-notice"], TEMPLATES["cc-by-nc-4.0-notice"]
    texts = [f"Intro. {mit} {mit} {mit} Outro.", f"{mit} some words between {cc} {'x ' * 90}{TEMPLATES['bsd-2-clause']} and {mit}"]
    one, two = scan_licenses(documents(shipped, texts), named=named).orderBy("doc_id").collect()
    assert [(h.license, h.first_word, h.last_word) for h in one.hits] == [("mit-notice", s, s + 4) for s in (1, 6, 11)]
    assert [h.license for h in two.hits] == ["mit-notice", "cc-by-nc-4.0-notice", "bsd-2-clause", "mit-notice"] and two.n_found == 3
