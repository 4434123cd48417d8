from __future__ import annotations

import numpy as np

from feedlens.llm import quality_rules
from test_scoring import WORD


def test_repeats_shorter_than_five_words_count():
    """Limits for n below BASE_N are measured on every document."""
    limits = {2: 0.1, 3: 0.1, 4: 0.1, 5: 0.15, 7: 0.1}
    texts = ["a b x1 a b x2 a b x3", "p q r y1 y2 p q r y3", "k l m n z1 k l m n z2", "one two three", "", "s t u v w s t u v w", "a a a a"]
    m = quality_rules.measure([t.encode() for t in texts], limits)
    for k, t in enumerate(texts):
        w = WORD.findall(t)
        for at, n in enumerate(sorted(limits)):
            seen, again = set(), set()
            for i in range(len(w) - n + 1):
                g = tuple(w[i : i + n])
                if g in seen:
                    again.update(range(i, i + n))
                seen.add(g)
            assert np.isclose(m["shares"][k][at], sum(len(w[i]) for i in again) / max(1, sum(map(len, w)))), (t, n)
    assert m["shares"][0][0] > 0 and m["shares"][1][1] > 0 and m["shares"][2][2] > 0
