"""Word lists and patterns used by the text-to-structure functions.

FIXED VALUES: the lists and regular expressions in this module must equal the dish
conventions they reproduce (keyword order matters: the first keyword found wins).  They are
data, not logic; the functions in ``mise.functions`` turn them into Spark column expressions.
Lists used for structured rows are the leading parts of the post lists, stated as slices.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES: keyword lists
CUISINES = [
    "italian", "mexican", "chinese", "japanese", "thai", "indian", "french", "mediterranean",
    "american", "greek", "korean", "vietnamese", "spanish", "german", "british", "caribbean",
    "turkish", "moroccan", "lebanese", "ethiopian", "brazilian", "argentinian", "peruvian",
    "filipino", "indonesian", "malaysian", "singaporean", "australian", "canadian", "south african",
]

COURSES = [
    "appetizer", "starter", "soup", "salad", "main dish", "main course", "side dish", "dessert",
    "beverage", "drink", "snack", "breakfast", "lunch", "dinner", "brunch", "sauce", "dip",
    "spread", "condiment", "marinade", "dressing", "topping", "garnish", "bread", "roll",
    "muffin", "cake", "cookie", "pie", "tart", "pastry", "candy", "ice cream", "pudding",
]

MEALS = [
    "breakfast", "brunch", "lunch", "dinner", "supper", "snack", "appetizer",
    "dessert", "midnight snack", "late night", "morning", "afternoon", "evening",
    "main course", "starter", "afternoon tea",
]

DIETARY = [
    "vegan", "vegetarian", "gluten-free", "dairy-free", "nut-free", "soy-free",
    "keto", "paleo", "low-carb", "high-protein", "raw", "organic", "halal", "kosher",
    "sugar-free", "low-sodium", "fat-free", "lactose-free", "egg-free", "shellfish-free",
]

# Structured rows (ingredients + directions) use shorter lists: the leading entries of the above.
CUISINES_STRUCTURED = CUISINES[:16]
COURSES_STRUCTURED = COURSES[:17]
MEALS_STRUCTURED = MEALS[:8]
DIETARY_STRUCTURED = DIETARY[:14]

# Meal type inferred from dish words when no meal keyword is present (first group that hits wins).
MEAL_GROUPS = [
    ("dessert", ["cake", "cookie", "pie", "tiramisu", "ice cream", "pudding", "cheesecake", "mousse",
                 "tart", "rolls", "muffin", "brownie", "donut", "cupcake"]),
    ("soup", ["soup", "stew", "broth"]),
    ("breakfast", ["pancake", "waffle", "toast", "cereal", "oatmeal"]),
    ("main", ["pizza", "burger", "sandwich", "pasta", "rice", "noodle", "chicken", "beef", "pork",
              "fish", "shrimp"]),
    ("snack", ["dip", "sauce", "spread", "cracker", "chip", "bite"]),
]

# Measurement units recognised at the start of an ingredient line, as listed by the convention.
UNITS = [
    "cup", "cups", "c", "c.",
    "tablespoon", "tablespoons", "tbsp", "tbsp.", "tbs", "tbs.", "T", "Tbsp", "Tbsp.",
    "teaspoon", "teaspoons", "tsp", "tsp.", "t",
    "pound", "pounds", "lb", "lbs", "lb.", "lbs.",
    "ounce", "ounces", "oz", "oz.",
    "gram", "grams", "g", "g.",
    "kilogram", "kilograms", "kg", "kg.",
    "milliliter", "milliliters", "ml", "ml.",
    "liter", "liters", "l", "l.",
    "quart", "quarts", "qt", "qt.",
    "pint", "pints", "pt", "pt.",
    "gallon", "gallons", "gal", "gal.",
    "pinch", "dash", "handful",
    "can", "cans", "jar", "jars", "package", "packages", "pkg", "box", "boxes",
    "clove", "cloves", "piece", "pieces", "slice", "slices",
    "stick", "sticks", "head", "heads", "bunch", "bunches",
]

# Difficulty and meal normalisation tables: (value, synonyms), tested in this order.
DIFFICULTY_SYNONYMS = [
    ("easy", ["easy", "simple", "beginner"]),
    ("hard", ["hard", "difficult", "advanced", "challenging"]),
    ("medium", ["medium", "moderate", "intermediate"]),
]
MEAL_SYNONYMS = [
    ("breakfast", ["breakfast", "brunch"]),
    ("lunch", ["lunch"]),
    ("dinner", ["dinner", "supper"]),
    ("snack", ["snack", "appetizer"]),
    ("dessert", ["dessert", "sweet"]),
]

# Servings guessed from pan size / dish words when no servings pattern matches.
SERVINGS_HINTS = [
    (["9x13", "13x9"], 12),
    (["8x8", "square pan"], 8),
    (["loaf pan", "bread"], 10),
    (["clusters", "cookies", "balls"], "pieces"),
    (["pizza", "pie"], 8),
    (["soup", "stew"], 6),
]

# Prep time guessed from technique words when no prep pattern matches.
PREP_HINTS = [
    (["tiramisu", "layered", "multiple steps"], "60-90"),
    (["whisk", "whip", "fold"], "30-45"),
    (["chop", "dice", "slice"], "20-30"),
]

# Difficulty words.
EASY_HINTS = ["simple", "quick", "basic"]
HARD_HINTS = ["complex", "advanced", "challenging"]
EASY_HINTS_STRUCTURED = ["simple", "quick"]
HARD_HINTS_STRUCTURED = ["complex", "advanced"]
MEDIUM_OVERRIDES = ["tiramisu", "layered", "multiple steps", "whip", "fold", "temper"]

# Description filters: a description line must not contain these words.
DESCRIPTION_EXCLUDES = ["ingredients", "directions", "instructions", "method"]

# ---------------------------------------------------------------- FIXED VALUES: patterns
# Section headers, tested on the lower-cased line after removing * # - _ : and trimming.
INGREDIENT_HEADER = r"^(ingredient|what you need|you('ll)? need|materials|items)"
INSTRUCTION_HEADER = r"^(instruction|direction|step|method|how to|preparation|prep|procedure)"
HEADER_MARKS = r"[*#\-_:]"
HEADER_MARK_CHARS = "*#-_:"

# Auto-detection when a text has no section headers.
MEASURE_LINE = r"(?i)\d+\.?\d*\s*(cup|tbsp|tsp|oz|lb|gram|ml|c\.|tsp\.|tbsp\.)"
VERB_LINE = r"(?i)^(mix|stir|add|pour|bake|cook|heat|boil|fry|blend|combine|place|put|remove|serve)"

# Separator-style ingredient lines.
LEADING_AMOUNT = (r"(?i)^(\d+(?:/\d+)?(?:\s+\d+/\d+)?(?:\s*(?:cup|tbsp|tsp|oz|lb|gram|ml|c\.|tsp\.|tbsp\.|"
                  r"tablespoon|teaspoon|ounce|pound|kilogram|liter|g|kg|l|ml|cl|dl))?\s*)")

# Servings, in order; the first that matches wins.
SERVINGS_PATTERNS = [
    r"(?:serves?|servings?|yields?|makes?)[:\s]+(\d+(?:\s*-\s*\d+)?)",
    r"servings?[:\s]+(\d+(?:\s*-\s*\d+)?)",
    r"makes?\s+(\d+)\s*(?:servings?|people|portions?)",
    r"(?:for|feeds?)\s+(\d+)\s*(?:people|servings?)",
    r"(\d+)\s*(?:servings?|people|portions?)",
]
PIECES_PATTERN = r"(\d+)\s*(?:clusters?|cookies?|balls?|pieces?)"

# Durations.
_D = r"(\d+(?:\s*-\s*\d+)?\s*(?:min|minute|hr|hour)s?)"
_D_SINGLE = r"(\d+\s*(?:min|minute|hr|hour)s?)"
PREP_PATTERNS = [
    r"prep(?:\s+time)?[:\s]+" + _D,
    r"prep\s+time[:\s]+" + _D,
    r"preparation(?:\s+time)?[:\s]+" + _D,
    r"(?:takes?\s+)?" + _D + r"\s*(?:to\s+)?prep",
]
COOK_PATTERNS = [
    r"cook(?:\s+time)?[:\s]+" + _D,
    r"cook\s+time[:\s]+" + _D,
    r"(?:cooking|bake)(?:\s+time)?[:\s]+" + _D,
    r"(?:bake|cook)\s+for\s+" + _D,
]
TOTAL_PATTERNS = [
    r"total(?:\s+time)?[:\s]+" + _D_SINGLE,
    r"total\s+(?:cooking\s+)?time[:\s]+" + _D_SINGLE,
    r"all\s+together[:\s]+" + _D_SINGLE,
]
# Structured rows: one pattern per field, ranges allowed for total.
PREP_PATTERNS_STRUCTURED = [PREP_PATTERNS[0]]
COOK_PATTERNS_STRUCTURED = [COOK_PATTERNS[0]]
TOTAL_PATTERNS_STRUCTURED = [r"total(?:\s+time)?[:\s]+" + _D]
SERVINGS_PATTERNS_STRUCTURED = [SERVINGS_PATTERNS[0]]

_W = "(easy|medium|hard|beginner|intermediate|advanced)"
DIFFICULTY_PATTERNS = [
    r"difficulty[:\s]+" + _W,
    r"(?:level|skill)[:\s]+" + _W,
    r"\b" + _W + r"\b",
    r"(?:super|very|really)\s+(easy|hard)",
]
DIFFICULTY_PATTERNS_STRUCTURED = [DIFFICULTY_PATTERNS[0]]

#: Words one of which a text must hold for a pattern to match it: a search for them is far cheaper than the pattern's.
NEEDED = {
    SERVINGS_PATTERNS[0]: ("serv", "yield", "make"), SERVINGS_PATTERNS[1]: ("serving",), SERVINGS_PATTERNS[2]: ("make",),
    SERVINGS_PATTERNS[3]: ("people", "serving"), SERVINGS_PATTERNS[4]: ("serving", "people", "portion"),
    **{p: ("prep",) for p in PREP_PATTERNS}, COOK_PATTERNS[0]: ("cook",), COOK_PATTERNS[1]: ("cook",), COOK_PATTERNS[2]: ("cooking", "bake"),
    COOK_PATTERNS[3]: ("bake", "cook"), **{p: ("total",) for p in TOTAL_PATTERNS}, TOTAL_PATTERNS[2]: ("together",),
    TOTAL_PATTERNS_STRUCTURED[0]: ("total",), DIFFICULTY_PATTERNS[0]: ("difficulty",), DIFFICULTY_PATTERNS[1]: ("level", "skill"),
    DIFFICULTY_PATTERNS[2]: ("easy", "medium", "hard", "beginner", "intermediate", "advanced"), DIFFICULTY_PATTERNS[3]: ("super", "very", "really"),
}

# Per-direction servings ("makes about N") and times read from directions only.
DIRECTION_MAKES = r"makes?\s+(?:about\s+)?(\d+)"
PREP_PATTERNS_DIRECTIONS = [r"prep(?:\s+time)?[:\s]+" + _D_SINGLE]
COOK_PATTERNS_DIRECTIONS = [r"(?:cook|bake)(?:\s+time)?[:\s]+" + _D_SINGLE]
TOTAL_PATTERNS_DIRECTIONS = [r"total(?:\s+time)?[:\s]+" + _D_SINGLE]

# ---------------------------------------------------------------- FIXED VALUES: text analysis
# English stop words of the standard search analyzer (Lucene's English stop set).
ENGLISH_STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
    "they", "this", "to", "was", "will", "with",
]

# BM25 defaults of the search engine being replaced.
BM25_K1 = 1.2
BM25_B = 0.75
