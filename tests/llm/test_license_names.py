from fleetscope.llm.licenses import IDENTITY, RELATED, TEMPLATES, scan_licenses, scan_words

from .conftest import documents

AGPL = RELATED["agpl-3.0-header"]


def test_every_identity_is_in_its_template():
    for name, phrases in IDENTITY.items():
        text = " ".join(scan_words((TEMPLATES | RELATED)[name]))
        assert all(f" {' '.join(scan_words(p))} " in f" {text} " for p in phrases), name


def test_neighbours_are_not_reported_under_a_wrong_name(shipped):
    cases = {
        "Licensed under CC BY 4.0.": "cc-by-4.0-short-notice",
        "This work is licensed under the GNU General Public License, version 2.": "gpl-2.0-notice",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "lgpl-3.0-notice",
        AGPL: "agpl-3.0-header",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "cc-by-nc-sa-4.0-long-notice",
        "Released under the Strange License.": None,
        "Released under the ISC License.": "isc-notice",
        RELATED["bsd-3-clause"].replace("endorse or", "endorse and or"): "bsd-3-clause",
        **{t: n for n, t in (TEMPLATES | RELATED).items()},
    }
    got = {r.doc_id: r for r in scan_licenses(documents(shipped, list(cases)), named=True).collect()}
    for i, (text, name) in enumerate(cases.items(), 1):
        assert got[i].license == name, (text, got[i])
