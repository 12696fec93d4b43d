"""Small word tables (fixed values). Every operator takes its own table as a parameter.

They are starter tables for English comments; callers with larger tables pass DataFrames to the join forms in ``operators.lookups``.
"""

from __future__ import annotations

# contraction -> expansion
CONTRACTIONS: dict[str, str] = {
    "ain't": "are not", "aren't": "are not", "can't": "cannot", "couldn't": "could not",
    "didn't": "did not", "doesn't": "does not", "don't": "do not", "hadn't": "had not",
    "hasn't": "has not", "haven't": "have not", "he'd": "he would", "he'll": "he will",
    "he's": "he is", "here's": "here is", "how'd": "how did", "how's": "how is",
    "i'd": "i would", "i'll": "i will", "i'm": "i am", "i've": "i have", "isn't": "is not",
    "it'd": "it would", "it'll": "it will", "it's": "it is", "let's": "let us",
    "ma'am": "madam", "mightn't": "might not", "mustn't": "must not", "needn't": "need not",
    "o'clock": "of the clock", "shan't": "shall not", "she'd": "she would",
    "she'll": "she will", "she's": "she is", "should've": "should have",
    "shouldn't": "should not", "that'd": "that would", "that's": "that is",
    "there'd": "there would", "there's": "there is", "they'd": "they would",
    "they'll": "they will", "they're": "they are", "they've": "they have",
    "wasn't": "was not", "we'd": "we would", "we'll": "we will", "we're": "we are",
    "we've": "we have", "weren't": "were not", "what'll": "what will", "what're": "what are",
    "what's": "what is", "when's": "when is", "where's": "where is", "who'd": "who would",
    "who'll": "who will", "who's": "who is", "why's": "why is", "won't": "will not",
    "would've": "would have", "wouldn't": "would not", "y'all": "you all",
    "you'd": "you would", "you'll": "you will", "you're": "you are", "you've": "you have",
}

STOP_WORDS: list[str] = (
    "a about above after again all am an and any are as at be because been before being below "
    "between both but by can could did do does doing down during each few for from further had "
    "has have having he her here hers him his how i if in into is it its itself just me more "
    "most my no nor not now of off on once only or other our out over own same she should so "
    "some such than that the their them then there these they this those through to too under "
    "until up very was we were what when where which while who whom why will with would you your"
).split()

# word class -> words; anything else falls to the suffix rules
TAG_LEXICON: dict[str, list[str]] = {
    "DT": "a an the this that these those each every some any no".split(),
    "IN": "of in on at by for from with into over under about between through during as if than".split(),
    "CC": "and or but nor yet".split(),
    "PRP": "i you he she it we they me him her us them".split(),
    "PRP$": "my your his its our their".split(),
    "MD": "can could may might must shall should will would cannot".split(),
    "TO": ["to"],
    "VB": "be do have go get make take see know think say come".split(),
    "VBZ": "is has does says goes makes gets".split(),
    "VBD": "was were had did said went made got took came".split(),
    "VBP": "are am".split(),
    "RB": "not very never always now then here there too also just".split(),
    "JJ": "good bad new old great stupid worthless pathetic disgusting ugly nice big small".split(),
    "WP": "who whom what".split(),
    "WRB": "when where why how".split(),
}

# irregular word -> lemma
LEMMA_EXCEPTIONS: dict[str, str] = {
    "children": "child", "feet": "foot", "teeth": "tooth", "geese": "goose", "mice": "mouse",
    "oxen": "ox", "lice": "louse", "people": "people", "data": "datum", "criteria": "criterion",
    "phenomena": "phenomenon", "indices": "index", "analyses": "analysis", "crises": "crisis",
    "lives": "life", "wives": "wife", "knives": "knife",
}

# word -> strength of feeling, from -4 to 4; values as in the public VADER sentiment lexicon (MIT licence)
VALENCE: dict[str, float] = {
    "good": 1.9, "great": 3.1, "nice": 1.8, "love": 3.2, "best": 3.2, "happy": 2.7,
    "thanks": 1.9, "thank": 1.5, "please": 1.3, "help": 1.7, "free": 2.3, "like": 1.5,
    "fair": 1.3, "clear": 1.6, "useful": 1.9, "welcome": 2.0, "agree": 1.5, "true": 1.8,
    "bad": -2.5, "worst": -3.1, "hate": -2.7, "stupid": -2.4, "idiot": -2.3, "moron": -2.2,
    "trash": -1.5, "scum": -2.8, "loser": -2.4, "clown": -1.0, "worthless": -1.9,
    "pathetic": -2.7, "disgusting": -2.4, "ugly": -2.3, "kill": -3.7, "die": -2.9,
    "dumb": -2.3, "liar": -2.3, "wrong": -2.1, "fool": -1.9, "shame": -2.1, "problem": -1.7,
}

# category -> words; the categories are the label names, in label order
CATEGORY_WORDS: dict[str, list[str]] = {
    "toxic": ["stupid", "idiot", "moron", "dumb", "liar"],
    "severe_toxic": ["scum", "disgusting", "vermin"],
    "obscene": ["trash", "crap", "damn"],
    "threat": ["kill", "die", "hurt", "shoot"],
    "insult": ["loser", "clown", "worthless", "pathetic", "fool"],
    "identity_hate": ["foreigner", "bigot", "racist"],
}

BAD_WORDS: list[str] = sorted({w for words in CATEGORY_WORDS.values() for w in words})

# singular nouns a plural may be reduced to
NOUNS: list[str] = (
    "article author band bird book boss box branch bus case church city class clown comment "
    "company contract country day dish document editor error example fact family file fool "
    "foreigner friend game group home hour idiot idea image issue item job kid leaf liar life "
    "line link list loser man match member message model moron month name nation note number "
    "order page part party person place point policy post problem question reader reason rule "
    "section source state story student system table tax team term thing time topic user "
    "version vote watch week wolf woman word year"
).split()

# a plural is reduced to a listed noun or to a word of a category
LEMMA_VOCABULARY: list[str] = sorted({*NOUNS, *BAD_WORDS})
