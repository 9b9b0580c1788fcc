"""Language profiles: the fixed character sets and word lists used by the text functions."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product


@dataclass(frozen=True)
class TextProfile:
    """Everything the text functions need to know about one written language."""

    name: str
    stripped_marks: str
    counted_marks: str
    elongation: str
    folds: tuple[tuple[str, str], ...]
    range_first: str
    range_last: str
    stopwords: tuple[str, ...]
    particles: tuple[str, ...]
    pronouns: tuple[str, ...]
    pronoun_folds: tuple[tuple[str, str], ...]
    person_suffixes: tuple[str, ...]
    person_min_length: int
    colons: str

    def spellings(self, word: str) -> list[str]:
        """All spellings which turn into `word` once ``pronoun_folds`` is applied."""
        sources: dict[str, list[str]] = {}
        for source, target in self.pronoun_folds:
            sources.setdefault(target, []).append(source)
        return ["".join(chars) for chars in product(*([c, *sources.get(c, [])] for c in word))]

    def folded_pronouns(self) -> list[str]:
        """Pronouns that can still occur in folded text; the others are dead entries."""
        gone = {source for source, _ in self.pronoun_folds}
        return [w for w in self.pronouns if not gone.intersection(w)]


# Word lists and character sets that results depend on.
_STOPWORDS = (
    "في", "من", "إلى", "على", "عن", "حتى", "منذ", "مذ", "خلال", "بين", "أمام", "خلف", "تحت", "فوق",
    "و", "ف", "ثم", "أو", "أم", "بل", "لكن", "كما", "حيث", "إذا", "إذ", "إن", "أن", "كان",
    "هو", "هي", "هم", "هن", "أنا", "نحن", "أنت", "أنتم", "ذلك", "تلك", "هذا", "هذه", "هؤلاء",
    "ها", "هما", "أنتما", "إياك", "إياه", "إياها",
    "كذلك", "أيضا", "أيضًا", "بعض", "كل", "جميع", "بعد", "قبل", "حول", "نحو", "ضد",
    "قد", "لقد", "لا", "ما", "لم", "لن", "ليس", "غير", "سوى",
    "كانت", "يكون", "تكون", "أصبح", "صار", "ظل", "بات",
    "إذن", "لذلك", "بحيث", "لذا",
    "أولا", "ثانيا", "ثالثا", "رابعا", "خامسا",
)
_PARTICLES = (
    "في", "من", "إلى", "على", "عن", "حتى", "منذ", "مذ", "خلال", "بين", "أمام", "خلف",
    "و", "ف", "ثم", "أو", "أم", "بل", "لكن", "كما",
    "أن", "لن", "كي", "إذن",
    "لم", "لما", "لا",
    "هل", "أ",
    "إن", "كأن", "ليت", "لعل",
)
_PRONOUNS = ("أنا", "انا", "نحن")
_STRIPPED_MARKS = "ًٌٍَُِّْ"
_COUNTED_MARKS = _STRIPPED_MARKS + "ٰٕٓٔ"
_TATWEEL = "ـ"
_ALEF_FOLDS = (("إ", "ا"), ("أ", "ا"), ("آ", "ا"))
_LETTER_FOLDS = _ALEF_FOLDS + (("ى", "ي"), ("ؤ", "و"), ("ئ", "ي"))
_PERSON_SUFFIXES = ("ت", "نا")
_COLONS = ":："

ARABIC = TextProfile(
    name="arabic",
    stripped_marks=_STRIPPED_MARKS,
    counted_marks=_COUNTED_MARKS,
    elongation=_TATWEEL,
    folds=_LETTER_FOLDS,
    range_first="؀",
    range_last="ۿ",
    stopwords=_STOPWORDS,
    particles=_PARTICLES,
    pronouns=_PRONOUNS,
    pronoun_folds=_ALEF_FOLDS,
    person_suffixes=_PERSON_SUFFIXES,
    person_min_length=4,
    colons=_COLONS,
)

# What Unicode-aware splitting treats as blank; Java's \s covers only the ASCII part.
UNICODE_BLANKS = "".join(
    chr(c)
    for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
