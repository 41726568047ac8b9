"""A plain Python reading of the text and scope rules, for small inputs."""

import math
import re

from clamor.functions import lexicon as lx
from clamor.functions.accents import fold_accents


def normalize(text):
    t = fold_accents(text.lower())
    t = re.sub(r"https?://\S+|www\.\S+", " ", t)
    t = re.sub(r"@\w+", " ", t)
    t = re.sub(r"\.\.\.|[.!?;:]+", f" {lx.PAUSE_TOKEN} ", t)
    t = re.sub(r",+", f" {lx.COMMA_TOKEN} ", t)
    return " ".join(re.sub(r"[^a-z0-9#'_ ]", " ", t).split())


def tokenize(text):
    t = normalize(text)
    for phrase in lx.PHRASES:
        t = t.replace(phrase, f" {lx.CONTRAST_TOKEN} ")
    return [w for w in t.split(" ") if len(w) > 1 and w not in lx.stopwords]


def score(text):
    tokens = tokenize(text)
    negated, factor, depth, raw, words, decisions = False, 1.0, 0, 0.0, [], 0
    for token in tokens:
        decisions += token in lx.scored_tokens
        if token in lx.clause_breaks:
            negated, factor = False, 1.0
            depth += token in lx.contrasts
        elif token in lx.negators:
            negated = True
        elif token in lx.modifier_factors:
            factor *= lx.modifier_factors[token]
        elif token in lx.polarity_weights:
            weight = lx.polarity_weights[token] * factor * (-1 if negated else 1)
            raw += max(-1.0, min(1.0, weight)) * 1.9**depth
            words.append(token)
    squashed = math.tanh(raw / 1.9)
    label = "POSITIVO" if squashed > 0.06 else "NEGATIVO" if squashed < -0.06 else "NEUTRAL"
    sure = min(1.0, abs(raw) / 2.2) * (0.6 + 0.4 * min(1.0, len(words) / 3))
    return {
        "sentiment": label, "score": squashed, "raw_score": raw, "confidence": sure,
        "tokens": len(tokens), "opinions": len(words), "decisions": decisions,
        "keywords": words[:4],
    }
