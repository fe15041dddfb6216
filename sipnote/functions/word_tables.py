"""Small word tables shipped with the library. Both are defaults of parameters."""

# Inflected form -> lemma, for the terms of the aspect lexicon and common review words.
LEMMAS: dict[str, str] = {
    "tastes": "taste", "tasted": "taste", "tasting": "taste",
    "flavors": "flavor", "flavored": "flavor",
    "hops": "hop", "malts": "malt", "sweeter": "sweet", "sweetest": "sweet",
    "fruitier": "fruity", "caramels": "caramel", "coffees": "coffee",
    "chocolates": "chocolate", "aromas": "aroma", "yeasts": "yeast",
    "cloves": "clove", "spices": "spice", "spiced": "spice", "bananas": "banana",
    "pines": "pine", "grapefruits": "grapefruit", "lemons": "lemon",
    "bodies": "body", "bodied": "body", "finishes": "finish", "finished": "finish",
    "finishing": "finish", "aftertastes": "aftertaste", "smoother": "smooth",
    "smoothest": "smooth", "drier": "dry", "driest": "dry", "creamier": "creamy",
    "crisper": "crisp", "thicker": "thick", "thickest": "thick", "thinner": "thin",
    "thinnest": "thin", "heavier": "heavy", "heaviest": "heavy", "lighter": "light",
    "lightest": "light", "textures": "texture", "fizzier": "fizzy", "flatter": "flat",
    "stickier": "sticky", "appearances": "appearance", "heads": "head",
    "lacings": "lacing", "colors": "color", "colored": "color", "pours": "pour",
    "poured": "pour", "pouring": "pour", "darker": "dark", "darkest": "dark",
    "browns": "brown", "hazier": "hazy", "clearer": "clear", "clearest": "clear",
    "cloudier": "cloudy", "foams": "foam", "foaming": "foam", "bottles": "bottle",
    "bottled": "bottle", "cans": "can", "canned": "can", "pints": "pint",
    "glasses": "glass", "labels": "label", "labeled": "label", "prices": "price",
    "priced": "price", "values": "value", "cheaper": "cheap", "cheapest": "cheap",
    "buys": "buy", "buying": "buy", "bought": "buy", "drafts": "draft",
    "taps": "tap", "costs": "cost", "growlers": "growler",
    "beers": "beer", "stouts": "stout", "ales": "ale", "lagers": "lager",
    "reviews": "review", "drinks": "drink", "drank": "drink", "drinking": "drink",
    "is": "be", "are": "be", "was": "be", "were": "be", "am": "be", "been": "be",
    "has": "have", "had": "have", "having": "have", "does": "do", "did": "do",
}

# English function words left out by content_tokens.
STOP_WORDS: list[str] = (
    "a about above after again against all almost also although always am among an and any are "
    "as at be because been before being below between both but by can could did do does doing "
    "down during each either else ever every few for from further had has have having he her "
    "here hers him his how i if in into is it its just least less many may me might more most "
    "much must my neither never no nor not now of off on once one only or other our ours out "
    "over own per quite rather really same she should since so some still such than that the "
    "their theirs them then there these they this those though through to too under until up "
    "upon us very was we were what when where whether which while who whom whose why will with "
    "within without would yet you your yours"
).split()
