"""Token ids word by word."""

import pytest

from basketry.llm.queries import tokenizer_path
from basketry.llm.tokens import WordEncoder

ODD = [
    "a<\u0338b x'S don't I'LL can'tx ẞa aßB", "Word\n\nNext \n x\n", "a" * 300 + "! b", 'é́e x.y,z;w:"q"', "a1b2,c3 4;5",
    " lead  two\n\n", "ÀÉ×÷ ÿ. þÐ", "x\u0301! y", "naïve—dash… a\u00adb", "İx ıy Å?", "a'\u0301s b’s", "tab\tx", "", "\n", " ", "中文 字!a", "1,000.50 a-b_c&&&",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_of_letters_need_the_merges_alone(name):
    encoder = WordEncoder(tokenizer_path(name))
    assert encoder.encode(ODD) == encoder._ids(ODD)
    text = "Zanthe norre, ñandú ofttre; Zanthe\nórre blué!"
    want = encoder._ids([text])
    library, asked = encoder._ids, []
    encoder._ids = lambda texts: asked.extend(texts) or library(texts)
    assert encoder.encode([text, text]) == want * 2
    assert not any(c.isalpha() for word in asked for c in word)
