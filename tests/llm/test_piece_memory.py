from spindle.llm import encode


def test_half_of_the_memory_is_for_pieces_that_come_again():
    """Words that never come again fill one half at most, so frequent words that come late are remembered still."""
    encode.encoder.cache_clear()
    e = encode.encoder(encode.tokenizer_path())
    letters = "abcdefghij"
    once = lambda i: "q" + "".join(letters[int(c)] for c in f"{i:07d}")
    for i in range(250_000):
        encode._Room.take(once(i), b"1234")
    assert 0 < encode._Room.left < encode.REMEMBERED // 2
    text = "late word late word, late word"
    assert e(text) == e(text) == e.whole(text)
    assert "late" in e.begins and "word" in e.follows
    encode.encoder.cache_clear()
