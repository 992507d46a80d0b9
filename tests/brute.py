"""Plain definitions of the text and scoring rules, for comparison on small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter

from gapledger import constants as C


def clean(text):
    if not text:
        return ""
    for curly, straight in zip("‘’“”", "''\"\""):
        text = re.sub("<[^>]+>", " ", text).replace(curly, straight)
    return " ".join(text.split())


def chunks(text):
    if not text:
        return [""]
    found = [s.strip() for s in re.split(r"(?<=[.!?])\s+", text)]
    return [s for s in found if len(s) > C.SHORT_SENTENCE] or [text]


def tokens(text, stop=frozenset(C.INDEX_STOPWORDS)):
    return [t for t in re.findall(r"\w+", text.lower()) if len(t) > 2 and t not in stop]


def index(docs):
    counts = {d: Counter(tokens(t)) for d, t in docs.items()}
    df = Counter(t for c in counts.values() for t in c)
    return {
        d: {t: n / sum(c.values()) * math.log(len(docs) / df[t]) for t, n in c.items()}
        for d, c in counts.items()
    }


def cosine(a, b):
    norms = math.dist(a.values(), [0] * len(a)) * math.dist(b.values(), [0] * len(b))
    return sum(v * b.get(t, 0.0) for t, v in a.items()) / norms if norms else 0.0


def query(text, binary=False):
    count = Counter(tokens(text))
    size = 1 if binary else max(sum(count.values()), 1)
    return {t: (1.0 if binary else n) / size for t, n in count.items()}


def top_k(docs, queries, k, binary=False):
    """{query: [(doc, score), ...]}, ties in document order."""
    weights = index(docs)
    result = {}
    for q, text in queries.items():
        vector = query(text, binary)
        scores = [(d, round(cosine(vector, weights[d]), 9)) for d in sorted(docs)]
        result[q] = sorted(scores, key=lambda x: (-x[1], x[0]))[:k]
    return result
