import pytest

from fleetscope.llm.deobfuscate import Decoder, char_counts, costs, words_of

from .conftest import documents


@pytest.fixture(scope="module")
def decoder(shipped):
    plain = "you are a stupid person and such an idiot the green house walked by the river the quiet moron stood in good weather"
    return Decoder(costs(char_counts(documents(shipped, [plain] * 50))))


@pytest.mark.parametrize("text, word", [("stuupid", "stupid"), ("iddiiott", "idiot"), ("an iddiot!", "idiot"),
                                        ("y o u s t u p i d", "stupid"), ("y o u m o r o n", "moron"), ("a n i d i o t y o u", "idiot")])
def test_doubled_letters_and_spaced_words_are_restored(decoder, text, word):
    assert word in words_of(text, decoder), words_of(text, decoder)


def test_natural_doubles_stay(decoder):
    assert words_of("the green good stood", decoder) == {"the", "green", "good", "stood"}
