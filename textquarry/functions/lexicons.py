"""Small word and domain lists that the signals use where the caller gives none."""

from __future__ import annotations

STOP_WORDS: dict[str, list[str]] = {
    lang: sorted(set(words.split()), key=lambda w: (w[::-1], w))
    for lang, words in {
        "en": "the of and a to in is it that was for on with as be by this at from or an are not but his her they which have had were been one all there their when who will more if no out so what up into than them can only other new some could time these two may then do any my now such like our over even most me after also did many before must through",
        "de": "der die das und in zu den mit von sich auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem einen so zum war haben nur oder aber vor zur bis mehr durch man dann",
        "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux d l n s mais comme ou si leur y dont elle deux ces tout nous sa fait ses lui bien peu sans",
        "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante",
        "it": "di e il la che in un a per è una sono del si da non con le i della più come al dei nel ha ma gli alla anche lo su o se delle questo ci tra due quando dal era suo",
        "fi": "ja on ei se että oli hän mutta ovat kun myös niin tai jos kuin sen ole joka mukaan vain sitä jo hänen nyt en olla sekä ne vielä mikä nämä voi",
        "bg": "и на да се в за от че с не е по са ще като до но а или това който бе към ли при след само още има няма ме ни те той тя ние вие",
    }.items()
}

#: Phrases of the block list by language; one phrase may have several words.
BAD_WORDS: dict[str, list[str]] = {
    "en": ["ofin", "thedon", "of the", "hell", "damn", "bloody hell"],
    "de": ["verbe", "der die", "mist"],
    "fr": ["de la", "merde", "zut"],
    "es": ["de la", "mierda"],
}

#: Host and block-list category; a host may have several.
DOMAIN_CATEGORIES: list[tuple[str, str]] = [
    ("ththre.example.com", "gambling"),
    ("ththre.example.com", "adult"),
    ("m.therou.example.com", "dating"),
    ("ththin.example.com", "phishing"),
    ("ththin.example.com", "gambling"),
    ("nowhere.example.com", "malware"),
]
CATEGORIES = ["adult", "dating", "gambling", "malware", "phishing"]
