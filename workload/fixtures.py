"""Small dictionaries that hit the invented words of the test tables.

They stand for a user's own dictionary files; each query joins them to whole tables.
"""

STOP = (
    "the of and to a in is that it for was on with be by as this are at from an"
    " de la le et les des en un du une que pour est qui par dans sur au pas"
    " der die und den von zu das mit sich auf dem im ein el y los se del las no con su al"
    " old large small us"
).split()

GENERIC = "Basics"

# store, tier, feature, component, keywords
CATEGORIES = [
    ("en", "1", "Core", "Rewh/Thre", "eriner thanea, ingre,  rewh"),
    ("en", None, "Core", "Basics", "thre, ernd, erat, ing, ha"),
    ("en", None, "Edge", "Gamma", "onre enat, anea-eriner, atshsh erin, that, ereser erinon"),
    ("en", None, "Edge", "Rewh/Thre", "erly, ing, thndly thtithly aterth"),
    ("fr", "1", "Core", "Delta", "tion, éque, elle, eux ment"),
    ("fr", None, "Core", "Basics", "ment, ai, éai"),
    ("de", None, "Core", "Epsilon", "sch, ung/heit, enau"),
    ("de", None, "Core", "Basics", "ver, ente"),
    ("es", None, "Core", "Zeta", "ción, mentes, ciónue"),
    ("es", None, "Core", "Basics", "ado, mente"),
    ("es", None, "Core", "Eta Theta", None),
]

# store, issue, keywords
ISSUES = [
    ("en", "Speed", "onre, thre er, re"),
    ("en", "Crash/Hang", "ernd, anea-eriner, this is"),
    ("en", "Bug", "erin, ingre"),
    ("fr", "Speed", "tion/eux, ai"),
    ("fr", "Look", "ment & elle, que"),
    ("de", "Speed", "sch, ung"),
    ("es", "Look", "ción, mente ado"),
    ("es", "Bug", "ado"),
]

# lower-case word, tag letter
TAGS = [
    (w, tag)
    for tag, words in {
        "D": "the a this la le les un une der die das el los las",
        "J": "that erat thre eau ai ver do ing ment",
        "V": "is was are be est ist es er ion",
        "I": "of in to for on with by at from de en par pour von mit por con",
        "O": "and et und y it as que qui se sich",
    }.items()
    for w in words.split()
]

# lower-case word, score
SENTIMENT = [
    ("the", 0.5), ("of", -0.25), ("and", 1.0), ("to", -1.0), ("this", -0.75), ("was", -1.0),
    ("de", 0.25), ("la", -0.5), ("et", 1.0), ("pas", -1.0), ("les", 0.75),
    ("der", -0.25), ("und", 1.0), ("nicht", -1.0), ("die", 0.5),
    ("que", -0.5), ("el", 0.75), ("no", -1.0), ("y", 1.0),
]

PART_KEYWORDS = [
    "red", "blue", "hot", "cold", "bolts", "rod", "ring", "red widget", "plate hot", "old",
    "small-gear", "new/red",
]

HIGH_WATER = "1997-06-01"
TODAY = "2024-01-15"
