"""The text rules restated character by character in plain Python, to check the Column functions."""

from scriptorium.functions.profiles import ARABIC

MARKS = {chr(c) for c in range(0x64B, 0x653)}
COUNTED = MARKS | {chr(c) for c in (0x653, 0x654, 0x655, 0x670)}
FOLD = {0x625: 0x627, 0x623: 0x627, 0x622: 0x627, 0x649: 0x64A, 0x624: 0x648, 0x626: 0x64A}


def bare(text):
    return "".join(ch for ch in text or "" if ch not in MARKS)


def cleaned(text):
    out = []
    for ch in bare(text):
        code = FOLD.get(ord(ch), ord(ch))
        if code != 0x640:
            out.append(chr(code) if 0x600 <= code <= 0x6FF else " ")
    return " ".join(w for w in "".join(out).split() if w not in ARABIC.stopwords)


def diacritics(text):
    return len([ch for ch in text or "" if ch in COUNTED])


def colons(text):
    return len([ch for ch in text or "" if ord(ch) in (0x3A, 0xFF1A)])


def particles(text):
    return len([w for w in bare(text).split() if w in ARABIC.particles])


def first_person(text):
    found = 0
    for word in bare(text).split():
        word = "".join(chr(0x627) if ord(ch) in (0x625, 0x623, 0x622) else ch for ch in word)
        ending = len(word) > 3 and (word[-1] == "ت" or word[-2:] == "نا")
        found += word in ARABIC.pronouns or ending
    return found
