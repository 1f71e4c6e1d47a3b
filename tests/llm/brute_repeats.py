"""Words that repeated windows cover, the plain way."""

import re
from collections import Counter


def kept(texts, length):
    """[(n_words, n_removed, kept words joined)] for a list of texts."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    times = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if times[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out
