"""Small random corpora and brute-force forms of the operators."""

from __future__ import annotations

import random
import re

WORDS = "the cat dog runs over blue hill while seven old men sing about rivers and stones in early May Rome éclair Über ñu".split()


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def prose(rng: random.Random, n: int, vocabulary: int = 4000) -> str:
    out = []
    for i in range(n):
        w = rng.choice(WORDS) if rng.random() < 0.3 else f"w{rng.randrange(vocabulary)}"
        out.append(w.capitalize() if rng.random() < 0.1 else w)
        if rng.random() < 0.1:
            out[-1] += rng.choice([".", ".", "!", ".\n", "\n"])
    return " ".join(out)


def corpus(seed: int = 1, n: int = 60) -> list[tuple[int | None, str | None]]:
    """Texts with exact copies, near copies, shared passages, short and odd texts, nulls and repeated rows."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    out: list[tuple[int | None, str | None]] = []
    for i in range(n):
        text = prose(rng, rng.choice([3, 12, 40, 80, 200, 400]))
        kind = rng.random()
        if out and kind < 0.15:
            text = rng.choice([t for _, t in out if t])
        elif out and kind < 0.4:
            w = rng.choice([t for _, t in out if t]).split(" ")
            for _ in range(rng.choice([1, 2, 5, 12])):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            text = " ".join(w)
        elif kind < 0.6:
            at = text.find(" ")
            text = f"{text[:at]} {passage} {text[at:]}"
        out.append((i, text))
    out += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "one"), (1004, "one two three"), (1005, "one  TWO\nthree"), (1006, "a b c d e"), (1007, "a\x00b ç"), (1008, "word " * 3000)]
    out += [out[5], (None, out[7][1]), (None, None)]
    return out
