import numpy as np

from stackroom.llm.words import BUFFER, hashed_words


def test_words_longer_than_a_buffer():
    long = b"x" * (3 * BUFFER)
    for text in [b"a " + long, b" " + long + b"\t\t" + long + b" b", long, b" " * (2 * BUFFER) + b"a"]:
        words = text.split()
        hashes, bounds = hashed_words([b"c", text, b"d"])
        assert bounds.tolist() == [0, 1, 1 + len(words), 2 + len(words)]
        single = [hashed_words([word])[0] for word in [b"c", *words, b"d"]]
        assert hashes.tolist() == np.concatenate(single).tolist()
