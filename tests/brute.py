"""Plain-Python forms that tests hold the operators against."""

from collections import Counter


def has_ngram_loop_py(text, n, k):
    words = (text or "").split()
    grams = Counter(zip(*(words[i:] for i in range(n))))
    return max(grams.values(), default=0) > k
