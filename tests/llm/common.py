"""Small documents with every awkward case, and plain Python versions of what the operators compute."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, ids string, _words int"


def lowered(text):
    return (text or "").translate(UPPER)


def rows(texts, first=0):
    """Documents from texts, with columns whose names the operators use inside."""
    return [(first + i, t, ["en", "de", None][i % 3], ["s0", "s1", None, "s0"][i % 4], 7, "k", "i", i) for i, t in enumerate(texts)]


def sentences(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def awkward():
    """Null, empty, blank and very long texts, repeated texts, odd characters and many line ends."""
    rng = random.Random(4)
    base = [sentences(rng, 120) for _ in range(12)]
    copies = [base[0], base[0], base[1].replace("w7", "w8", 1), base[2] + " tail", base[3].upper()]
    odd = [None, "", " \t\n ", "one", "a b c", "\n\n\n", "x" * 5000, "ÀÉ straße ÅÑ ΣΑΣ ﬁ İ \x1c\x1d\x85\xa0 z é",
           "it's we'll I'd 12½ ³ <|endoftext|> <|startoftext|>x <|endoftext|>", "😀😀 漢字かな кот", "!!!???", "# $ % & | < > *"]
    return base + copies + odd + [sentences(rng, 30000, 50)]
