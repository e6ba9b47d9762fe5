"""Suffix stemming of token arrays.

Spark has no stemmer, so this is the one text step that runs in Python: an Arrow batch
function over token arrays.  Words repeat heavily, so each worker keeps the stems it has
worked out and a repeated word costs one lookup.  Nothing is shuffled for it.  Four languages
are functions here; those of ``stem_rules`` are data.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.functions import stem_rules
from lexigrid.functions.stopwords import LANGUAGES, language_name

# The published suffix rules of the English, German, Spanish and French stemmers.
EN_VOWELS = "aeiouy"
EN_WHOLE = dict(
    pair.split(":")
    for pair in (
        "skis:ski skies:sky dying:die lying:lie tying:tie idly:idl gently:gentl ugly:ugli "
        "early:earli only:onli singly:singl sky:sky news:news howe:howe atlas:atlas "
        "cosmos:cosmos bias:bias andes:andes"
    ).split()
)
EN_KEEP_AFTER_PLURAL = set("inning outing canning herring earring proceed exceed succeed".split())
EN_STEP2 = dict(
    pair.split(":")
    for pair in (
        "tional:tion enci:ence anci:ance abli:able entli:ent izer:ize ization:ize ational:ate "
        "ation:ate ator:ate alism:al aliti:al alli:al fulness:ful ousli:ous ousness:ous "
        "iveness:ive iviti:ive biliti:ble bli:ble fulli:ful lessli:less ogi:og li:"
    ).split()
)
EN_STEP3 = dict(
    pair.split(":")
    for pair in "tional:tion ational:ate alize:al icate:ic iciti:ic ical:ic ful: ness: ative:".split()
)
EN_STEP4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()
DE_VOWELS = "aeiouyäöü"
ES_VOWELS = "aeiouáéíóúü"
ES_PRONOUNS = "me se sela selo selas selos la le lo las les los nos".split()
ES_PLAIN = (
    "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas "
    "amiento amientos imiento imientos"
).split()
ES_IC = "adora ador ación adoras adores aciones ante antes ancia ancias".split()
ES_SWAP = dict(
    pair.split(":")
    for pair in "logía:log logías:log ución:u uciones:u encia:ente encias:ente".split()
)
ES_Y_VERBS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
ES_SHORT_VERBS = "en es éis emos".split()
ES_VERBS = (
    "arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais "
    "ería eréis eríamos eremos erá eré irían irías irán irás iríais iría iréis iríamos iremos irá "
    "iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían aran ieran asen iesen "
    "aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis "
    "abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos "
    "iéramos iésemos ásemos"
).split()
FR_VOWELS = "aeiouyâàëéêèïîôûù"
FR_PLAIN = "ance iqUe isme able iste eux ances iqUes ismes ables istes".split()
FR_ATION = "atrice ateur ation atrices ateurs ations".split()
FR_SWAP = dict(
    pair.split(":")
    for pair in (
        "logie:log logies:log usion:u ution:u usions:u utions:u ence:ent ences:ent"
    ).split()
)
FR_OTHER = (
    "ement ements ité ités if ive ifs ives eaux aux euse euses issement issements amment emment "
    "ment ments"
).split()
FR_I_VERBS = (
    "îmes ît îtes i ie ies ir ira irai iraIent irais irait iras irent irez iriez irions irons "
    "iront is issaIent issais issait issant issante issantes issants isse issent isses issez "
    "issiez issions issons it"
).split()
FR_E_VERBS = (
    "é ée ées és èrent er era erai eraIent erais erait eras erez eriez erions erons eront ez iez"
).split()
FR_A_VERBS = (
    "âmes ât âtes a ai aIent ais ait ant ante antes ants as asse assent asses assiez assions"
).split()


def _region(word: str, vowels: str, start: int = 0) -> int:
    """Where the part after the first consonant that follows a vowel begins."""
    found = re.search(f"[{vowels}][^{vowels}]", word[start:])
    return start + found.end() if found else len(word)


def _longest(word: str, suffixes) -> str | None:
    fitting = [s for s in suffixes if word.endswith(s)]
    return max(fitting, key=len) if fitting else None


def _ends_short(word: str) -> bool:
    return bool(
        re.search(f"[^{EN_VOWELS}][{EN_VOWELS}][^{EN_VOWELS}wxY]$", word)
        or re.fullmatch(f"[{EN_VOWELS}][^{EN_VOWELS}]", word)
    )


def _english(word: str) -> str:
    if len(word) <= 2:
        return word
    if word in EN_WHOLE:
        return EN_WHOLE[word]
    word = word.lstrip("'")
    word = re.sub(f"(^|(?<=[{EN_VOWELS}]))y", "Y", word)
    special = re.match("gener|commun|arsen", word)
    r1 = special.end() if special else _region(word, EN_VOWELS)
    r2 = _region(word, EN_VOWELS, r1)

    word = re.sub("('s'|'s|')$", "", word)
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith(("ied", "ies")):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("s") and not word.endswith(("us", "ss")):
        if re.search(f"[{EN_VOWELS}]", word[:-2]):
            word = word[:-1]
    if word in EN_KEEP_AFTER_PLURAL:
        return word

    ending = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if ending in ("eed", "eedly"):
        if len(word) - len(ending) >= r1:
            word = word[: -len(ending)] + "ee"
    elif ending and re.search(f"[{EN_VOWELS}]", word[: -len(ending)]):
        word = word[: -len(ending)]
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif re.search("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$", word):
            word = word[:-1]
        elif _ends_short(word) and r1 >= len(word):
            word += "e"
    if re.search(f".[^{EN_VOWELS}][yY]$", word):
        word = word[:-1] + "i"

    ending = _longest(word, EN_STEP2)
    if ending and len(word) - len(ending) >= r1:
        stem = word[: -len(ending)]
        allowed = {"ogi": "l", "li": "cdeghkmnrt"}.get(ending)
        if allowed is None or stem[-1:] and stem[-1] in allowed:
            word = stem + EN_STEP2[ending]
    ending = _longest(word, EN_STEP3)
    if ending and len(word) - len(ending) >= (r2 if ending == "ative" else r1):
        word = word[: -len(ending)] + EN_STEP3[ending]
    ending = _longest(word, EN_STEP4)
    if ending and len(word) - len(ending) >= r2:
        if ending != "ion" or word[: -len(ending)].endswith(("s", "t")):
            word = word[: -len(ending)]
    if word.endswith("e"):
        if len(word) - 1 >= r2 or (len(word) - 1 >= r1 and not _ends_short(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word.replace("Y", "y")


def _german(word: str) -> str:
    word = word.replace("ß", "ss")
    word = re.sub(f"(?<=[{DE_VOWELS}])[uy](?=[{DE_VOWELS}])", lambda m: m[0].upper(), word)
    first = _region(word, DE_VOWELS)
    r2 = _region(word, DE_VOWELS, first)
    r1 = max(first, 3)

    def cut(ending: str | None, region: int) -> bool:
        return ending is not None and len(word) - len(ending) >= region

    ending = _longest(word, ("em", "ern", "er", "e", "en", "es", "s"))
    if cut(ending, r1):
        stem = word[: -len(ending)]
        if ending != "s":
            word = stem
            if ending in ("e", "en", "es") and word.endswith("niss"):
                word = word[:-1]
        elif stem[-1:] and stem[-1] in "bdfghklmnrt":
            word = stem
    ending = _longest(word, ("en", "er", "est", "st"))
    if cut(ending, r1):
        stem = word[: -len(ending)]
        if ending != "st" or re.search("...[bdfghklmnt]$", stem):
            word = stem
    ending = _longest(word, ("end", "ung", "ig", "ik", "isch", "lich", "heit", "keit"))
    if cut(ending, r2):
        stem = word[: -len(ending)]
        if ending in ("end", "ung"):
            word = stem
            if cut("ig", r2) and re.search("(?<!e)ig$", word):
                word = word[:-2]
        elif ending in ("ig", "ik", "isch"):
            word = word if stem.endswith("e") else stem
        elif ending in ("lich", "heit"):
            word = stem
            if word.endswith(("er", "en")) and cut("er", r1):
                word = word[:-2]
        else:
            word = stem
            extra = _longest(word, ("lich", "ig"))
            if cut(extra, r2):
                word = word[: -len(extra)]
    return word.translate(str.maketrans("UYäöü", "uyaou"))


def _drop_before(word: str, region: int, *steps: str) -> str:
    """Remove the first of the given endings, if it lies in the region."""
    for ending in steps:
        if word.endswith(ending):
            return word[: -len(ending)] if len(word) - len(ending) >= region else word
    return word


def _spanish(word: str) -> str:
    r1 = _region(word, ES_VOWELS)
    r2 = _region(word, ES_VOWELS, r1)
    rv = len(word)
    if len(word) > 2:
        first, second = word[0] in ES_VOWELS, word[1] in ES_VOWELS
        if not second:
            found = re.search(f"[{ES_VOWELS}]", word[2:])
            rv = 2 + found.end() if found else rv
        elif first:
            found = re.search(f"[^{ES_VOWELS}]", word[2:])
            rv = 2 + found.end() if found else rv
        else:
            rv = 3
    plain = str.maketrans("áéíóú", "aeiou")

    pronoun = _longest(word, ES_PRONOUNS)
    if pronoun and len(word) - len(pronoun) >= rv:
        stem = word[: -len(pronoun)]
        verb = _longest(stem, ("iéndo", "ándo", "ár", "ér", "ír", "ando", "iendo", "ar", "er", "ir", "yendo"))
        if verb and len(stem) - len(verb) >= rv:
            if verb != "yendo":
                word = stem[: -len(verb)] + verb.translate(plain)
            elif stem.endswith("uyendo"):
                word = stem

    before = word
    endings = [*ES_PLAIN, *ES_IC, *ES_SWAP, "amente", "mente", "idad", "idades", "iva", "ivo", "ivas", "ivos"]
    ending = _longest(word, endings)
    if ending and len(word) - len(ending) >= (r1 if ending == "amente" else r2):
        word = word[: -len(ending)]
        if ending in ES_SWAP:
            word += ES_SWAP[ending]
        elif ending in ES_IC:
            word = _drop_before(word, r2, "ic")
        elif ending == "amente":
            shorter = _drop_before(word, r2, "iv", "os", "ic", "ad")
            word = _drop_before(shorter, r2, "at") if word.endswith("iv") and shorter != word else shorter
        elif ending == "mente":
            word = _drop_before(word, r2, "ante", "able", "ible")
        elif ending in ("idad", "idades"):
            word = _drop_before(word, r2, "abil", "ic", "iv")
        elif ending in ("iva", "ivo", "ivas", "ivos"):
            word = _drop_before(word, r2, "at")
    if word == before:
        in_rv = word[rv:]
        ending = _longest(in_rv, ES_Y_VERBS)
        if ending and word[: -len(ending)].endswith("u"):
            word = word[: -len(ending)]
        else:
            ending = _longest(in_rv, [*ES_SHORT_VERBS, *ES_VERBS])
            if ending:
                word = word[: -len(ending)]
                if ending in ES_SHORT_VERBS and word.endswith("gu"):
                    word = word[:-1]
    ending = _longest(word[rv:], ("os", "a", "o", "á", "í", "ó", "e", "é"))
    if ending:
        word = word[: -len(ending)]
        if ending in ("e", "é") and word.endswith("gu") and len(word) - 1 >= rv:
            word = word[:-1]
    return word.translate(plain)


def _french(word: str) -> str:
    v = FR_VOWELS
    word = re.sub(f"(?<=[{v}])[ui](?=[{v}])|(?<=[{v}])y|y(?=[{v}])|(?<=q)u", lambda m: m[0].upper(), word)
    r1 = _region(word, v)
    r2 = _region(word, v, r1)
    if re.match(f"[{v}][{v}]", word) or re.match("par|col|tap", word):
        rv = min(3, len(word))
    else:
        found = re.search(f"[{v}]", word[1:])
        rv = 1 + found.end() if found else len(word)
    start = word

    def cut(ending: str, region: int) -> bool:
        return len(word) - len(ending) >= region

    go_on = True
    ending = _longest(word, [*FR_PLAIN, *FR_ATION, *FR_SWAP, *FR_OTHER])
    if ending:
        stem = word[: -len(ending)]
        done = None
        if ending in FR_PLAIN:
            done = stem if cut(ending, r2) else None
        elif ending in FR_ATION:
            if cut(ending, r2):
                done = stem
                if stem.endswith("ic"):
                    done = stem[:-2] if len(stem) - 2 >= r2 else stem[:-2] + "iqU"
        elif ending in FR_SWAP:
            done = stem + FR_SWAP[ending] if cut(ending, r2) else None
        elif ending in ("ement", "ements"):
            if cut(ending, rv):
                done = stem
                if stem.endswith("iv"):
                    done = _drop_before(stem, r2, "iv")
                    if done != stem:
                        done = _drop_before(done, r2, "at")
                elif stem.endswith("eus"):
                    if len(stem) - 3 >= r2:
                        done = stem[:-3]
                    elif len(stem) - 3 >= r1:
                        done = stem[:-3] + "eux"
                elif stem.endswith(("abl", "iqU")):
                    done = stem[:-3] if len(stem) - 3 >= r2 else stem
                elif stem.endswith(("ièr", "Ièr")):
                    done = stem[:-3] + "i" if len(stem) - 3 >= rv else stem
        elif ending in ("ité", "ités"):
            if cut(ending, r2):
                done = stem
                if stem.endswith("abil"):
                    done = stem[:-4] if len(stem) - 4 >= r2 else stem[:-4] + "abl"
                elif stem.endswith("ic"):
                    done = stem[:-2] if len(stem) - 2 >= r2 else stem[:-2] + "iqU"
                else:
                    done = _drop_before(stem, r2, "iv")
        elif ending in ("if", "ive", "ifs", "ives"):
            if cut(ending, r2):
                done = stem
                if stem.endswith("at") and len(stem) - 2 >= r2:
                    done = stem[:-2]
                    if done.endswith("ic"):
                        done = done[:-2] if len(done) - 2 >= r2 else done[:-2] + "iqU"
        elif ending == "eaux":
            done = stem + "eau"
        elif ending == "aux":
            done = stem + "al" if cut(ending, r1) else None
        elif ending in ("euse", "euses"):
            done = stem if cut(ending, r2) else stem + "eux" if cut(ending, r1) else None
        elif ending in ("issement", "issements"):
            done = stem if cut(ending, r1) and stem[-1:] and stem[-1] not in v else None
        elif ending in ("amment", "emment"):
            word = stem + ("ant" if ending == "amment" else "ent") if cut(ending, rv) else word
        elif stem[-1:] and stem[-1] in v and len(stem) - 1 >= rv:
            word = stem
        if done is not None:
            go_on, word = False, done
    if go_on:
        before = word
        ending = _longest(word[rv:], FR_I_VERBS)
        if ending and len(word) - len(ending) > rv and word[-len(ending) - 1] not in v:
            word = word[: -len(ending)]
        if word == before:
            ending = _longest(word[rv:], ["ions", *FR_E_VERBS, *FR_A_VERBS])
            if ending == "ions":
                word = word[:-4] if cut(ending, r2) else word
            elif ending:
                word = word[: -len(ending)]
                if ending in FR_A_VERBS and word[rv:].endswith("e"):
                    word = word[:-1]
    if word != start:
        word = re.sub("Y$", "i", re.sub("ç$", "c", word))
    else:
        word = re.sub("(?<=[^aiouès])s$", "", word)
        ending = _longest(word[rv:], ("ion", "ier", "ière", "Ier", "Ière", "e", "ë"))
        if ending == "ion":
            if cut(ending, r2) and word[rv:-3].endswith(("s", "t")):
                word = word[:-3]
        elif ending == "ë":
            word = word[:-1] if word.endswith("guë") else word
        elif ending == "e":
            word = word[:-1]
        elif ending:
            word = word[: -len(ending)] + "i"
    if word.endswith(("enn", "onn", "ett", "ell", "eill")):
        word = word[:-1]
    word = re.sub(f"[éè]([^{v}]+)$", r"e\1", word)
    return word.lower()


STEMMERS = {
    "english": _english, "german": _german, "spanish": _spanish, "french": _french,
    **{name: rules.stem for name, rules in stem_rules.RULES.items()},
}


def supported_languages() -> list[str]:
    return sorted(STEMMERS)


def stemmer_name(language: str) -> str:
    """Full name of a language, or an error if it has no rules."""
    name = language_name(language)
    if name not in STEMMERS:
        raise ValueError(f"no stemmer for {name}; there are {', '.join(supported_languages())}")
    return name


KNOWN: dict[tuple[str, str], str] = {}
KNOWN_LIMIT = 200_000


def stem_word(word: str, language: str) -> str:
    """Stem of one lower-case word.

    The language may come from a row, so one without rules keeps the word; where a query names
    it, ``stemmer_name`` is an error first.
    """
    stem = KNOWN.get((word, language))
    if stem is None:
        rule = STEMMERS.get(LANGUAGES.get(language, language))
        stem = rule(word) if rule else word
        if len(KNOWN) >= KNOWN_LIMIT:
            KNOWN.clear()
        KNOWN[(word, language)] = stem
    return stem


@F.arrow_udf(T.ArrayType(T.StringType()))
def _stem_arrays(tokens: pa.Array, language: pa.Array) -> pa.Array:
    """Stems by the distinct words of a batch: its tokens stay Arrow buffers and only distinct
    words become Python strings."""
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    words, languages = tokens.flatten().dictionary_encode(), language.dictionary_encode()
    of = np.repeat(languages.indices.to_numpy(zero_copy_only=False), sizes)
    known = pc.fill_null(words.indices, len(words.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
    spelled, named = [*words.dictionary.to_pylist(), None], languages.dictionary.to_pylist()
    pairs = pa.array(known * max(len(named), 1) + of).dictionary_encode()
    stems = [
        None if spelled[word] is None else stem_word(spelled[word], named[lang])
        for word, lang in (divmod(pair, max(len(named), 1)) for pair in pairs.dictionary.to_pylist())
    ]
    values = pa.array(stems, pa.string()).take(pairs.indices)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), values, mask=tokens.is_null())


# The rules travel with the function, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(stem_rules)


def stem_tokens(tokens: Column, language: Column) -> Column:
    return _stem_arrays(tokens, F.coalesce(language, F.lit("none")))
