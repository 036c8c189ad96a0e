"""The word table against the whole tokenizer: case, special tokens, punctuation and scripts."""

from __future__ import annotations

from array import array

import pytest

tokenizers = pytest.importorskip("public_tokenizers")

from riskweft.llm.tokens import WIDE, WordIds, loaded  # noqa: E402

TEXTS = [
    "Word WORD word, WORD. word... (Word) don't DON'T A1b a1B 1,234 x_y X_Y",
    "before <|endoftext|> after <|ENDOFTEXT|> <|EndOfText|>Word WORD<|startoftext|>",
    "École école ÉCOLE Kelvin İİ ΟΔΟΣ Σ straße STRASSE 中文 word Word",
    "",
    "  \t\n ",
    "?! ... -- \" \"Quoted\" a b C",
]


@pytest.mark.parametrize("table_bytes", [0, 1 << 20])
def test_word_table_equals_the_whole_tokenizer(table_bytes):
    path = tokenizers.path("word_bpe_49k.json")
    table, whole = WordIds(path, WIDE, table_bytes), loaded(path)
    for _ in range(2):
        found = table.texts([t.encode() for t in TEXTS] + [None])
        wanted = [array(WIDE, whole.encode(t, add_special_tokens=False).ids).tobytes() for t in TEXTS] + [b""]
        assert found == wanted


def test_words_share_an_entry_whatever_their_case():
    table = WordIds(tokenizers.path("word_bpe_49k.json"))
    table.texts([b"Word WORD word wOrd"])
    assert list(table) == [b"word"]
