"""Verb-object pairs of instructions by a small tagger: closed word classes, endings, and what stands before a word."""

from __future__ import annotations

import re

_TOKEN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|[.!?;:\n]|[^\s\w]|\w+")
_END = set(".!?;:\n")
#: Closed classes: words that are the same part of speech nearly always.
_DETERMINERS = set("a an the this that these those all any some each every no both either neither my your his her its our their another such".split())
_PREPOSITIONS = set("of in on at by for with from into onto to over under between through during before after about against as like per via without within across along around behind below above near off out up down than instead".split())
_PRONOUNS = set("i you he she it we they me him us them itself themselves there what which who whom".split())
_CONJUNCTIONS = set("and or but so because if when while where whenever unless until although though since whether then that".split())
_AUXILIARIES = set("be is are was were been being am do does did have has had will would can could shall should may might must not n't".split())
_ADVERBS = set("faster slower better sooner later more less also just only now then please very too again always never first next finally instead here already still even".split())
#: Verbs of edit instructions in their plain form. Other words count as verbs by ending, or behind "to" or an auxiliary.
_VERBS = set(
    "add allow apply append assign avoid build cache call catch change check clean clear close combine compare compute convert copy count create debug "
    "define delete describe disable display divide document drop enable ensure enhance explain expose extend extract fetch fill filter find fix format "
    "generate get give group handle hide implement import improve include increase initialize insert introduce iterate join keep limit list load log loop make "
    "merge mock modify move normalize open optimize order organize output parse pass perform print process provide raise read reduce refactor remove rename "
    "replace report require reset return reverse revise rewrite round run save search select send separate set show simplify skip sort split start stop store "
    "support swap switch sum test throw track transform translate trim turn update use validate verify wrap write".split()
)
_ADJECTIVE = re.compile(r".+(?:ous|ful|less|able|ible|ive|ish|ic)$")
_VERB_END = re.compile(r".+(?:ify|ise|ize|ate)$")


def tagged(words: list[str]) -> list[str]:
    """A tag for each lower-case word: V, N, D, P, A, R (adverb), O (anything that ends a phrase)."""
    out: list[str] = []
    for k, w in enumerate(words):
        before = out[-1] if out else "O"
        begins = k == 0 or words[k - 1] in _END or words[k - 1] in _CONJUNCTIONS or words[k - 1] in _ADVERBS or words[k - 1] in (",", "to") or words[k - 1] in _AUXILIARIES
        if not w[0].isalpha() or w in _CONJUNCTIONS and w != "that" or w in _AUXILIARIES or w in _PRONOUNS:
            out.append("O")
        elif w in _DETERMINERS:
            out.append("D")
        elif w in _PREPOSITIONS:
            out.append("P")
        elif w in _ADVERBS or w.endswith("ly") and len(w) > 4:
            out.append("R")
        elif begins and before not in ("D", "A") and (w in _VERBS or _VERB_END.match(w) or k > 0 and words[k - 1] == "to"):
            out.append("V")
        elif _ADJECTIVE.match(w) or w.endswith("ed") and before == "D":
            out.append("A")
        else:
            out.append("N")
    return out


def verb_object_pairs(text: str) -> list[tuple[str, str]]:
    """Each verb with the head of the noun phrase that follows it, the last of the nouns in a row: ``add``, ``docstring``.

    Between the two only determiners, adjectives, adverbs, numbers and nouns may stand. A verb without an object gives
    nothing.
    """
    words = [w.lower() for w in _TOKEN.findall(text)]
    tags = tagged(words) if words else []
    out = []
    for k, tag in enumerate(tags):
        if tag != "V":
            continue
        head, spare = None, None  # "variable" looks like an adjective and is a noun where no other follows
        for w, t in zip(words[k + 1 :], tags[k + 1 :]):
            if t == "N":
                head = w
            elif t == "A" and head is None:
                spare = w
            elif head is not None or not (t in "DAR" or w.isdigit()):
                break
        if head or spare:
            out.append((words[k], head or spare))
    return out
