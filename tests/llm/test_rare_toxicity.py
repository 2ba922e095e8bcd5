import random

import pytest

from fleetscope.llm.toxicity import toxicity

from .conftest import documents


@pytest.mark.parametrize("n, every", [(80, 8), (1500, 100)])
def test_few_toxic_labels_are_learned_from(shipped, n, every):
    """Four insults in turn, so that each is in fewer than six toxic texts of the fit."""
    rng = random.Random(3)
    plain = ["the", "house", "green", "walked", "river", "stone", "evening", "quiet", "letter", "window"]
    bad = ["moron", "idiot", "scumbag", "worthless"]
    texts = [" ".join([*rng.choices(plain, k=20), *([bad[i // every % 4]] if i % every == 0 else [])]) for i in range(n)]
    labels = shipped.createDataFrame([(i + 1, int(i % every == 0)) for i in range(n)], "doc_id long, toxic int")
    out = toxicity(documents(shipped, texts), labels).join(labels, "doc_id").collect()
    assert all(r.predicted == r.toxic for r in out if not r.held_out), [r for r in out if r.predicted != r.toxic]
    assert not any(r.predicted > r.toxic for r in out)


def test_the_sample_keeps_all_rare_labels(shipped):
    from fleetscope.llm.toxicity import fit

    texts = [f"river stone {'moron' if i % 100 == 0 else 'house'}" for i in range(1200)]
    labels = shipped.createDataFrame([(i + 1, int(i % 100 == 0)) for i in range(1200)], "doc_id long, toxic int")
    model = fit(documents(shipped, texts).select("doc_id", "text"), labels, fit_rows=60)
    assert "=moron" in model.index and model.weights[model.index["=moron"]] > 0
