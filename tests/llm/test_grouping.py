import collections
import random

from eventlens.llm.grouping import repeated_starts, suffix_array


def test_suffix_array_sorts():
    rng = random.Random(2)
    for _ in range(500):
        text = [rng.randrange(1, rng.choice([2, 3, 9])) for _ in range(rng.randrange(40))]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeated_starts_match_counting():
    rng = random.Random(4)
    for letters in (b"a", b"ab", b"abcdefgh", bytes(range(256))):
        for _ in range(20):
            base = bytes(rng.choice(letters) for _ in range(300))
            contents = [base[a:a + rng.randrange(120)] for a in (rng.randrange(250) for _ in range(5))]
            times = collections.Counter(c[i:i + 30] for c in contents for i in range(len(c) - 29))
            want = [[times[c[i:i + 30]] > 1 for i in range(len(c) - 29)] for c in contents]
            assert [f.tolist() for f in repeated_starts([contents], 30)[0]] == want
