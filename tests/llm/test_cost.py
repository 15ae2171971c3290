import random
import re

import public_tokenizers

from roadcast.llm import tokens


def test_cuts_are_those_of_patterns_that_go_back():
    letter = tokens._LETTER
    plain = re.compile(rf"[ \t\n\r]*[{letter}]+(?=[.,;:|!?])|[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
    bare = re.compile(rf"[{letter}]+(?=[.,;:|!?])|[^ \t\n\r]+")
    rng = random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choice("abÀ×ÿ .,;:|!?\t\n\r1-语") for _ in range(rng.randrange(12)))
        assert tokens.CUT.findall(text) == plain.findall(text)
        assert tokens.BARE_CUT.findall(text) == bare.findall(text)
    assert all(re.match(r"[^\S \t\n\r]", c) for c in tokens.RARE_SPACES) and len(tokens.RARE_SPACES) == 25


def test_new_words_of_a_byte_tokenizer_are_encoded_many_at_once(monkeypatch):
    """A call's result holds far fewer encodings than words, and the ids of each word are its own."""
    encoder = tokens.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdéÀ语'<|>s") for _ in range(rng.randrange(1, 8)))
    words = list(dict.fromkeys(rng.choice([" ", "\n", "  ", "", "\r\n\t"]) + word() for _ in range(3000)))
    words += [" <|endoftext|>", " ", "\n ", " a\u00a0", "\u00a0b c"]
    sizes = []
    whole = encoder.tokenizer.encode_batch_fast

    class Counting:
        def encode_batch_fast(self, texts, **more):
            sizes.append(len(texts))
            return whole(texts, **more)

    flat, lengths = tokens.encoded_words(Counting(), words, encoder.bytes_of)
    expected = [e.ids for e in whole(words, add_special_tokens=False)]
    assert lengths.tolist() == [len(ids) for ids in expected]
    assert flat.tolist() == [i for ids in expected for i in ids]
    assert sum(sizes) < len(words) / 2
