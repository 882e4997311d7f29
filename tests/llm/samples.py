"""Small corpora with copies, near copies, shared passages and odd texts."""

from __future__ import annotations

import random


def corpus(seed: int, many: int = 60, vocabulary: int = 300, longest: int = 160) -> list[tuple[int, str | None]]:
    """Documents of random words; many are edited copies or hold passages of others."""
    rnd = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"W{i}é" for i in range(vocabulary)]
    passages = [[rnd.choice(words) for _ in range(rnd.randint(8, 40))] for _ in range(4)]
    texts: list[list[str]] = []
    for _ in range(many):
        kind = rnd.random()
        if texts and kind < 0.15:
            text = list(rnd.choice(texts))
        elif texts and kind < 0.4:
            text = list(rnd.choice(texts))
            for _ in range(rnd.randint(1, 6)):
                at = rnd.randint(0, len(text))
                text[at : at + rnd.randint(0, 2)] = [rnd.choice(words) for _ in range(rnd.randint(0, 2))]
        else:
            text = [rnd.choice(words) for _ in range(rnd.randint(0, longest))]
        if kind > 0.6:
            at = rnd.randint(0, len(text))
            text[at:at] = rnd.choice(passages)
        texts.append(text)
    rows: list[tuple[int, str | None]] = []
    for i, text in enumerate(texts):
        rows.append((i * 7 % (many * 7 + 1), "".join(w + rnd.choice(["\n", "  ", "\t", " ", " ", " "]) for w in text)))
    odd = [None, "", "   \n\t ", "one", "Two words", "a b c", "w1 " * 400, "é è ê\x0bç\x0cà", "x" * 5000]
    return rows + [(10_000 + i, t) for i, t in enumerate(odd)]
