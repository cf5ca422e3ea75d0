"""Small corpora: words of a few languages, copies, near copies, shared passages, odd rows."""

import random

SYLLABLES = {
    "en": "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split(),
    "fr": "le de ré è qu eau ou ai en eux la on re ti an ê é ch ment ier vi pa tre tion aux ç oi".split(),
    "de": "en er ch de ei un te ge sch ie ä ü be ß ver lich keit auf au ö heit pf zu ung".split(),
}


def word(rng, lang="en"):
    return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))


def prose(rng, n, lang="en"):
    out = []
    for i in range(n):
        w = word(rng, lang)
        out.append(w.capitalize() if i % 9 == 0 else w + rng.choice(["", "", "", ",", ".", ".\n"]))
    return " ".join(out)


def odd_rows(first_id=1000):
    """Nulls, empties, ties and repeated rows."""
    texts = [None, "", " \t\n", "...", "é", "word", "word", "a b c", "A  b\nc", "a b c d e", "A B C D E", "x " * 300, "x " * 300]
    rows = [(first_id + i, t) for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[11], (None, "a b c d e"), (None, None)]


def corpus(seed, n=60, words=120):
    """Prose with exact copies, near copies of several degrees, and passages in many documents."""
    rng = random.Random(seed)
    passages = [prose(rng, rng.choice([18, 20, 25, 70])) for _ in range(4)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.15:
            text = rng.choice(rows)[1]
        elif rows and kind < 0.45:
            words_ = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randint(1, max(1, len(words_) // 25))):
                words_[rng.randrange(len(words_))] = word(rng)
            text = " ".join(words_)
        else:
            text = prose(rng, rng.randint(5, words))
        if rng.random() < 0.4:
            at = rng.randrange(len(text) + 1)
            text = f"{text[:at]} {rng.choice(passages)} {text[at:]}"
        rows.append((i, text))
    return rows
