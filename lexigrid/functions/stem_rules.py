"""Suffix stemmers as data, and the one interpreter that runs them.

A language is its vowels, letters to swap first, regions of the word and a tree of steps.  A
step takes the longest of its suffixes that the word ends with; the suffix's rule says in
which region it must lie, what must stand before it, what replaces it and which steps follow.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    suffixes: str
    region: str | None = None
    put: str = ""
    after: str = ""
    then: tuple = ()


class Step:
    """Rules of which the longest suffix decides; ``within`` ignores suffixes outside a region."""

    def __init__(self, *rules: Rule, within: str | None = None):
        self.within = within
        self.table = {s: (r, re.compile(f"(?:{r.after})$")) for r in rules for s in r.suffixes.split()}
        self.lengths = sorted({len(s) for s in self.table}, reverse=True)

    def run(self, word: str, marks: dict[str, int]) -> str | None:
        room = len(word) - (marks[self.within] if self.within else 0)
        for n in self.lengths:
            if n <= room and word[-n:] in self.table:
                rule, after = self.table[word[-n:]]
                stem = word[:-n]
                if (rule.region and len(stem) < marks[rule.region]) or not after.search(stem):
                    return None
                return Each(*rule.then).run(stem + rule.put, marks) or stem + rule.put
        return None


class Each:
    """All parts in turn; None if none of them changes the word."""

    def __init__(self, *parts):
        self.parts = parts

    def run(self, word: str, marks: dict[str, int]) -> str | None:
        changed = None
        for part in self.parts:
            changed = part.run(changed or word, marks) or changed
        return changed


class First(Each):
    """The first part that changes the word."""

    def run(self, word: str, marks: dict[str, int]) -> str | None:
        return next((done for part in self.parts if (done := part.run(word, marks)) is not None), None)


class Led(Each):
    """The later parts only if the first changes the word."""

    def run(self, word: str, marks: dict[str, int]) -> str | None:
        done = self.parts[0].run(word, marks)
        return None if done is None else Each(*self.parts[1:]).run(done, marks) or done


@dataclass(frozen=True)
class Language:
    vowels: str
    steps: Each
    rv: Callable[[str, str], int] | None = None
    least_r1: int = 0
    swap: tuple[tuple[str, str], ...] = ()
    consonants: Callable[[str, str], str] = lambda word, vowels: word
    back: tuple[tuple[str, str], ...] = ()

    def stem(self, word: str) -> str:
        for old, new in self.swap:
            word = word.replace(old, new)
        word = self.consonants(word, self.vowels)
        r1 = after_vowel_run(word, self.vowels)
        marks = {"r1": max(r1, self.least_r1), "r2": after_vowel_run(word, self.vowels, r1)}
        if self.rv:
            marks["rv"] = self.rv(word, self.vowels)
        word = self.steps.run(word, marks) or word
        for old, new in self.back:
            word = word.replace(old, new)
        return word


def after_vowel_run(word: str, vowels: str, start: int = 0) -> int:
    """Where the part after the first consonant that follows a vowel begins."""
    found = re.search(f"[{vowels}][^{vowels}]", word[start:])
    return start + found.end() if found else len(word)


def romance_rv(word: str, vowels: str) -> int:
    if len(word) <= 2:
        return len(word)
    if word[1] not in vowels:
        found = re.search(f"[{vowels}]", word[2:])
    elif word[0] in vowels:
        found = re.search(f"[^{vowels}]", word[2:])
    else:
        return 3
    return 2 + found.end() if found else len(word)


def after_first_vowel(word: str, vowels: str) -> int:
    found = re.search(f"[{vowels}]", word)
    return found.end() if found else len(word)


def italian_consonants(word: str, vowels: str) -> str:
    letters = list(word.replace("qu", "qU"))
    for i in range(1, len(letters) - 1):
        if letters[i] in "ui" and letters[i - 1] in vowels and letters[i + 1] in vowels:
            letters[i] = letters[i].upper()
    return "".join(letters)


def dutch_consonants(word: str, vowels: str) -> str:
    letters = list(word)
    for i, letter in enumerate(letters):
        follows = i > 0 and letters[i - 1] in vowels
        if letter == "y" and (i == 0 or follows):
            letters[i] = "Y"
        elif letter == "i" and follows and letters[i + 1 : i + 2] and letters[i + 1] in vowels:
            letters[i] = "I"
    return "".join(letters)


# The published suffix rules of each language's stemmer.
SWEDISH = Language(
    vowels="aeiouyäåö",
    least_r1=3,
    steps=Each(
        Step(
            Rule(
                "a arna erna heterna orna ad e ade ande arne are aste en anden aren heten ern ar er heter or "
                "as arnas ernas ornas es ades andes ens arens hetens erns at andet het ast"
            ),
            Rule("s", after="[bcdfghjklmnoprtvy]"),
            within="r1",
        ),
        Step(
            Rule("dd", put="d"), Rule("gd gt", put="g"), Rule("nn", put="n"), Rule("dt", put="d"),
            Rule("kt", put="k"), Rule("tt", put="t"), within="r1",
        ),
        Step(Rule("lig ig els"), Rule("löst", put="lös"), Rule("fullt", put="full"), within="r1"),
    ),
)

NORWEGIAN = Language(
    vowels="aeiouyæåø",
    least_r1=3,
    steps=Each(
        Step(
            Rule(
                "a e ede ande ende ane ene hetene en heten ar er heter as es edes endes enes hetenes ens "
                "hetens ers ets et het ast"
            ),
            Rule("s", after="[bcdfghjlmnoprtvyz]|[^aeiouyæåø]k"),
            Rule("erte ert", put="er"),
            within="r1",
        ),
        Step(Rule("dt", put="d"), Rule("vt", put="v"), within="r1"),
        Step(Rule("leg eleg ig eig lig elig els lov elov slov hetslov"), within="r1"),
    ),
)

DANISH_PAIRS = Step(Rule("gd gt", put="g"), Rule("dt", put="d"), Rule("kt", put="k"), within="r1")
DANISH = Language(
    vowels="aeiouyæåø",
    least_r1=3,
    steps=Each(
        Step(
            Rule(
                "hed ethed ered e erede ende erende ene erne ere en heden eren er heder erer heds es endes "
                "erendes enes ernes eres ens hedens erens ers ets erets et eret"
            ),
            Rule("s", after="[abcdfghjklmnoprtvyzå]"),
            within="r1",
        ),
        DANISH_PAIRS,
        Step(Rule("igst", put="ig")),
        Step(Rule("ig lig elig els", then=(DANISH_PAIRS,)), Rule("løst", put="løs"), within="r1"),
        Step(*[Rule(c, after=c) for c in "bcdfghjklmnpqrstvwxz"], within="r1"),
    ),
)

DUTCH_UNDOUBLE = Step(Rule("kk", put="k"), Rule("dd", put="d"), Rule("tt", put="t"))
DUTCH_EN = "(?<!gem)(?<=[^aeiouyè])"
DUTCH_E = Step(Rule("e", "r1", after="[^aeiouyè]", then=(DUTCH_UNDOUBLE,)))
DUTCH_HEID = Step(Rule("heid", "r2", after="(?<!c)", then=(Step(Rule("en", "r1", after=DUTCH_EN, then=(DUTCH_UNDOUBLE,))),)))
DUTCH_IG = Rule("ig", "r2", after="(?<!e)")
DUTCH_ENDINGS = (
    Rule("end ing", "r2", then=(First(Step(DUTCH_IG), DUTCH_UNDOUBLE),)),
    DUTCH_IG, Rule("lijk", "r2", then=(DUTCH_E,)), Rule("baar", "r2"),
)
DUTCH = Language(
    vowels="aeiouyè",
    least_r1=3,
    swap=tuple(zip("äëïöüáéíóú", "aeiouaeiou")),
    consonants=dutch_consonants,
    back=(("Y", "y"), ("I", "i")),
    steps=Each(
        Step(
            Rule("heden", "r1", put="heid"),
            Rule("en ene", "r1", after=DUTCH_EN, then=(DUTCH_UNDOUBLE,)),
            Rule("s se", "r1", after="[^aeiouyèj]"),
        ),
        First(
            Led(DUTCH_E, DUTCH_HEID, Step(*DUTCH_ENDINGS, Rule("bar", "r2"))),
            Each(DUTCH_HEID, Step(*DUTCH_ENDINGS)),
        ),
        Step(*[Rule(v + v + d, put=v + d, after="[^aeiouyè]") for v in "aeou" for d in "bcdfghjklmnpqrstvwxzY"]),
    ),
)

IT_PRONOUNS = (
    "ci gli la le li lo mi ne si ti vi sene gliela gliele glieli glielo gliene mela mele meli melo mene "
    "tela tele teli telo tene cela cele celi celo cene vela vele veli velo vene"
).split()
IT_FIRST = Step(
    Rule(
        "anza anze ico ici ica ice iche ichi ismo ismi abile abili ibile ibili ista iste isti istà istè istì "
        "oso osi osa ose mente atrice atrici ante anti",
        "r2",
    ),
    Rule("azione azioni atore atori", "r2", then=(Step(Rule("ic", "r2")),)),
    Rule("logia logie", "r2", put="log"),
    Rule("uzione uzioni usione usioni", "r2", put="u"),
    Rule("enza enze", "r2", put="ente"),
    Rule("amento amenti imento imenti", "rv"),
    Rule("amente", "r1", then=(Step(Rule("iv", "r2", then=(Step(Rule("at", "r2")),)), Rule("os ic abil", "r2")),)),
    Rule("ità", "r2", then=(Step(Rule("abil ic iv", "r2")),)),
    Rule("ivo ivi iva ive", "r2", then=(Step(Rule("at", "r2", then=(Step(Rule("ic", "r2")),))),)),
)
IT_VERBS = Step(
    Rule(
        "ammo ando ano are arono asse assero assi assimo ata ate ati ato ava avamo avano avate avi avo emmo "
        "enda ende endi endo erà erai eranno ere erebbe erebbero erei eremmo eremo ereste eresti erete erò "
        "erono essero ete eva evamo evano evate evi evo Yamo iamo immo irà irai iranno ire irebbe irebbero "
        "irei iremmo iremo ireste iresti irete irò irono isca iscano isce isci isco iscono issero ita ite iti "
        "ito iva ivamo ivano ivate ivi ivo ono uta ute uti uto ar ir"
    ),
    within="rv",
)
ITALIAN = Language(
    vowels="aeiouàèìòù",
    rv=romance_rv,
    swap=tuple(zip("áéíóú", "àèìòù")),
    consonants=italian_consonants,
    back=(("I", "i"), ("U", "u")),
    steps=Each(
        Step(
            *[Rule(verb + p, "rv", put=verb) for verb in ("ando", "endo") for p in IT_PRONOUNS],
            *[Rule(verb + p, "rv", put=verb + "e") for verb in ("ar", "er", "ir") for p in IT_PRONOUNS],
        ),
        First(IT_FIRST, IT_VERBS),
        Step(Rule("a e i o à è ì ò", "rv", then=(Step(Rule("i", "rv")),))),
        Step(Rule("ch", "rv", put="c"), Rule("gh", "rv", put="g")),
    ),
)

PT_FIRST = Step(
    Rule(
        "eza ezas ico ica icos icas ismo ismos ável ível ista istas oso osa osos osas amento amentos imento "
        "imentos adora ador aça~o adoras adores aço~es ante antes ância",
        "r2",
    ),
    Rule("logia logias", "r2", put="log"),
    Rule("uça~o uço~es", "r2", put="u"),
    Rule("ência ências", "r2", put="ente"),
    Rule("amente", "r1", then=(Step(Rule("iv", "r2", then=(Step(Rule("at", "r2")),)), Rule("os ic ad", "r2")),)),
    Rule("mente", "r2", then=(Step(Rule("ante avel ível", "r2")),)),
    Rule("idade idades", "r2", then=(Step(Rule("abil ic iv", "r2")),)),
    Rule("iva ivo ivas ivos", "r2", then=(Step(Rule("at", "r2")),)),
    Rule("ira iras", "rv", put="ir", after="e"),
)
PT_VERBS = Step(
    Rule(
        "ada ida ia aria eria iria ará ara erá era irá ava asse esse isse aste este iste ei arei erei irei am "
        "iam ariam eriam iriam aram eram iram avam em arem erem irem assem essem issem ado ido ando endo indo "
        "ara~o era~o ira~o ar er ir as adas idas ias arias erias irias arás aras erás eras irás avas es ardes "
        "erdes irdes ares eres ires asses esses isses astes estes istes is ais eis íeis aríeis eríeis iríeis "
        "áreis areis éreis ereis íreis ireis ásseis ésseis ísseis áveis ados idos ámos amos íamos aríamos "
        "eríamos iríamos áramos éramos íramos ávamos emos aremos eremos iremos ássemos êssemos íssemos imos "
        "armos ermos irmos eu iu ou ira iras"
    ),
    within="rv",
)
PORTUGUESE = Language(
    vowels="aeiouáéíóúâêô",
    rv=romance_rv,
    swap=(("ã", "a~"), ("õ", "o~")),
    back=(("a~", "ã"), ("o~", "õ")),
    steps=Each(
        First(
            Led(First(PT_FIRST, PT_VERBS), Step(Rule("i", "rv", after="c"))),
            Step(Rule("os a i o á í ó", "rv")),
        ),
        Step(
            Rule("e é ê", "rv", then=(Step(Rule("u", "rv", after="g"), Rule("i", "rv", after="c")),)),
            Rule("ç", put="c"),
        ),
    ),
)


def russian_group(suffixes: str) -> list[Rule]:
    """Suffixes that stand after а or я, which stays and lies in the region too."""
    return [Rule(before + s, put=before) for s in suffixes.split() for before in "ая"]


RU_ADJECTIVE = Rule(
    "ее ие ые ое ими ыми ей ий ый ой ем им ым ом его ого ему ому их ых ую юю ая яя ою ею",
    then=(Step(*russian_group("ем нн вш ющ щ"), Rule("ивш ывш ующ"), within="rv"),),
)
RU_VERB = Step(
    *russian_group("ла на ете йте ли й л ем н ло но ет ют ны ть ешь нно"),
    Rule(
        "ила ыла ена ейте уйте ите или ыли ей уй ил ыл им ым ен ило ыло ено ят ует уют ит ыт ены ить ыть ишь ую ю"
    ),
    within="rv",
)
RU_NOUN = Step(
    Rule(
        "а ев ов ие ье е иями ями ами еи ии и ией ей ой ий й иям ям ием ем ам ом о у ах иях ях ы ь ию ью ю ия ья я"
    ),
    within="rv",
)
RU_NN = Step(Rule("нн", put="н"), within="rv")
RUSSIAN = Language(
    vowels="аеиоуыэюя",
    rv=after_first_vowel,
    swap=(("ё", "е"),),
    steps=Each(
        First(
            Step(*russian_group("в вши вшись"), Rule("ив ивши ившись ыв ывши ывшись"), within="rv"),
            Each(Step(Rule("ся сь"), within="rv"), First(Step(RU_ADJECTIVE, within="rv"), RU_VERB, RU_NOUN)),
        ),
        Step(Rule("и"), within="rv"),
        Step(Rule("ост ость", "r2"), within="rv"),
        Step(Rule("нн", put="н"), Rule("ейш ейше", then=(RU_NN,)), Rule("ь"), within="rv"),
    ),
)

RULES = {
    "swedish": SWEDISH, "norwegian": NORWEGIAN, "danish": DANISH, "dutch": DUTCH, "italian": ITALIAN,
    "portuguese": PORTUGUESE, "russian": RUSSIAN,
}
