"""Pre-token cutting gives exactly the library's ids, over every character it calls safe and mixtures with others."""

import random

import brute
import numpy as np

from fishladder.llm.tokens import IdBytes, Tokens, vocabulary_path


def test_ids_are_the_library_s_own():
    rnd = random.Random(12)
    library, enc = brute.tokenizer(), IdBytes(Tokens(vocabulary_path()), "<u2")
    safe = [chr(c) for c in range(0x20, 0x7F)] + ["\t", "\n", "\r"] + [chr(c) for c in range(0xC0, 0x180)]
    odd = list("\x00\x0b\x1c\x85 İͅΣς́​  　﻿日本é😀½²Ⅷẞﬁ")
    texts = ["".join(rnd.choice(safe) for _ in range(200)) for _ in range(300)]
    texts += ["".join(rnd.choice(safe[:95]) for _ in range(200)) for _ in range(300)]
    texts += ["".join(rnd.choice(safe + odd * 6) for _ in range(120)) for _ in range(600)]
    texts += ["".join(rnd.choice(["'s", "'LL", "'", "’s", " ", "a", "Ab", "1", "<|endoftext|>", "<|", "|>", ".", "\n", "é"]) for _ in range(60))
              for _ in range(400)]
    texts += [c + "a" + c for c in safe + odd] + ["A" * 5000, "é" * 3000 + "1" * 50]
    for t in texts:
        got = np.frombuffer(enc.encode(t), dtype="<u2").tolist()
        assert got == library.encode(t, add_special_tokens=False).ids, repr(t)
