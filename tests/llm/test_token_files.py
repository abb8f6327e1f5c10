"""The word tokenizer of the token files: ids of odd words, and the work for a word."""

import cProfile
import pstats
import random

import numpy as np
from tokenizers import Tokenizer

from faultline.llm import token_files


def test_words_are_learned_with_few_calls():
    """Odd words have the library's ids, and what is done for a word in Python is little: below 14 calls each, 23 once."""
    rng = random.Random(5)
    parts = ["a", "Ion", "é", "ŕ", "ÇE", "İ", "ß", "ſ", "ı", "Ω", "é", "'s", "–", ",", ".", "9", "日", "\x85", "\xa0", "ĳ", "Ǆ"]
    odd = ["".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(3000)]
    texts = [" ".join(odd[k : k + 50]) for k in range(0, len(odd), 50)]
    plain = Tokenizer.from_file(token_files.TOKENIZER)
    words = token_files.WordTokenizer(token_files.TOKENIZER)
    got = words.encode([t.encode() for t in texts])
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    letters = "abcdeéèàçklmnoprst"
    fresh = {"".join(rng.choices(letters, k=9)) + rng.choice(["", "", ",", "."]) for _ in range(20_000)}
    calls = cProfile.Profile()
    calls.runcall(words.encode, [" ".join(sorted(fresh)).encode()])
    assert pstats.Stats(calls).total_calls < 14 * len(fresh)
