"""The classifiers' scores of one text, worked out feature by feature with plain numbers."""

import math
import re
from collections import Counter

from hourlake.llm import features, quality_model, toxicity

WORD, BASE = 1 << 64, 0x9E3779B97F4A7C15


def mix(h):
    h = (h ^ (h >> 33)) * 0xFF51AFD7ED558CCD % WORD
    h = (h ^ (h >> 29)) * 0xC4CEB9FE1A85EC53 % WORD
    return h ^ (h >> 32)


def hash_of(data):
    return mix(sum(int(features._BYTES[b]) * pow(BASE, k, WORD) for k, b in enumerate(data)) % WORD)


def quality_features(text):
    grams = (text[i : i + n] for n in quality_model.SIZES for i in range(len(text) - n + 1))
    found = [hash_of(g) for g in grams]
    words = [hash_of(w) for w in text.split()]
    found += [mix((w + 7) % WORD) for w in words]
    found += [0 if a == b else mix((a * 31 + b) % WORD) for a, b in zip(words, words[1:], strict=False)]
    return Counter(h >> (64 - quality_model.BITS) for h in found)


def quality_score(model, text):
    counts = quality_features(text or b"")
    total = sum(n * float(model.weights[f]) for f, n in counts.items())
    return 1 / (1 + math.exp(-(total / max(1, sum(counts.values())) + model.bias)))


def toxicity_score(model, text):
    clean = 1.0
    for sentence in re.split(rb"[.!?\n]", (text or b"").lower()):
        words = re.findall(rb"[0-9a-z\x80-\xff]+", sentence)
        if not words:
            continue
        found = [hash_of(w) for w in words]
        found += [mix((hash_of(w[:n]) + n) % WORD) for w in words for n in toxicity.STEMS if len(w) > n]
        logit = model.bias + sum(float(model.weights[h >> (64 - toxicity.BITS)]) for h in found)
        clean *= 1 - 1 / (1 + math.exp(-logit))
    return 1 - clean
