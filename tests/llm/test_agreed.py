"""Texts with characters that the libraries may treat differently are found in one pass."""

from halyard.llm.pieces import AGREED, disagreed


def test_disagreed_is_agreed_character_by_character():
    chars = [chr(i) for i in range(0x3200) if not 0xD800 <= i < 0xE000] + list("一龥龦鿿가豈\U0001F600\U00020000")
    assert disagreed(chars) == [AGREED.search(c) is not None for c in chars]
    assert disagreed(["a\nb é", None, "", "x\x1cy", "caf́"]) == [False, None, False, True, True]
    assert disagreed([]) == []
