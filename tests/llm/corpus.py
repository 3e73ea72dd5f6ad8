"""Small corpora and comparisons for the tests of the training-data operators."""

import random

SYLLABLES = "the re an ti on er nd ha es en st ou at or in ing ed is it al ar de la çé ña ü ber ung".split()


def sentence(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


def edited(rng, text, share):
    words = text.split(" ")
    for i in range(len(words)):
        if rng.random() < share:
            words[i] = "".join(rng.choices(SYLLABLES, k=3))
    return " ".join(words)


def corpus(seed=5):
    """(doc_id, text) rows with copies, near copies, shared passages, repeats
    inside a text, nulls, empty, blank, short and very long texts."""
    rng = random.Random(seed)
    passage, line = sentence(rng, 60), sentence(rng, 14)
    texts = [sentence(rng, rng.randint(30, 150)) for _ in range(40)]
    texts += [texts[i] for i in (0, 0, 3, 7)]
    texts += [edited(rng, texts[i % 6], 0.01) for i in range(18)]
    texts += [sentence(rng, 40) + "\n" + passage + "\n" + sentence(rng, 20) for _ in range(6)]
    texts += [line + "\n" + sentence(rng, 30) + "\n" + line for _ in range(8)]
    texts += [None, "", "   \n\t ", "one", "one", "two words", "a b c d", "a b c d e", "###", "é" * 60, "x" * 300,
              "ab " * 400, "The THE the tHe THE", sentence(rng, 20_000), " lead and trail \x0b\x0c\r\n"]
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[9], (None, texts[0]), (None, None)]


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
