"""Small tables with every awkward case, and plain forms of the word contracts."""

import random
import re

import public_tokenizers

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, host string, id string, rep string, k int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def awkward_documents():
    """Rows of SCHEMA: nulls everywhere, empty and very long texts, copies, repeated rows, clashing columns."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéß ñ") for _ in range(rng.randint(1, 9))).strip() or "x"
    base = [" ".join(word() for _ in range(rng.randint(8, 120))) for _ in range(40)]
    texts = list(base)
    for t in base[:12]:
        w = t.split()
        w[len(w) // 2] = "changed"
        texts.append(" ".join(w))
    texts += base[:5] + [None, "", " \n\t ", "one", "one two", "ONE two", "a b c d e", "a b c d e f", "12 34 %% --"]
    long = " ".join(word() for _ in range(9000))
    texts += [long, long[: len(long) // 2] + " other end", "aaaa" * 500, "\n".join(["the same line over and over again in one text"] * 60)]
    shared = " ".join(word() for _ in range(90))
    texts += [f"{t} {shared} {t}" for t in base[20:26]]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "ä", None]), None if t is None else len(t), "clash", "h", "i", "r", 1))
    rows += [rows[3], rows[3], rows[45]]  # repeated rows
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(awkward_documents() if rows is None else rows, SCHEMA)
