"""A few recipes of our own, shaped like the raw dataset."""

import json

# name, ingredients, cookTime, prepTime, total minutes, level
DISHES = [
    ("Stew", "2 pounds Beef Chuck\nsalt", "PT2H", "PT20M", 140, "hard"),
    ("Tacos", "ground beef\ntortillas", "PT10M", "PT15M", 25, "easy"),
    ("Burger", "BEEF patties\nbuns", "PT15M", "PT15M", 30, "medium"),
    ("Lasagne", "minced beef\npasta", "PT40M", "PT20M", 60, "medium"),
    ("Ragout", "corned beefsteak", "PT45M", "PT16M", 61, "hard"),
    ("Steak", "beef fillet", "PT14M59S", "PT15M59S", 29, "easy"),
    ("Soup", "beef stock", "PT0S", "PT5M", 5, "easy"),
    ("Salad", "lettuce\ntomato", "PT0M", "PT10M", 10, "easy"),
    ("Bread", "flour\nyeast", "PT1H", "PT2H", 180, "hard"),
    ("Mystery", None, "PT1H", "PT2H", 180, "hard"),
]
WITH_BEEF = [dish for dish in DISHES if dish[1] and "beef" in dish[1].lower()]
# (140 + 61) / 2, (30 + 60) / 2, (25 + 29 + 5) / 3
AVERAGES = {"hard": 100.5, "medium": 45.0, "easy": 59 / 3}


def row(name, ingredients, cook, prep, number=0):
    return {
        "name": name,
        "ingredients": ingredients,
        "url": f"http://example.com/{name.lower()}/{number}",
        "image": f"http://example.com/{name.lower()}.jpg",
        "cookTime": cook,
        "recipeYield": "4",
        "datePublished": "2011-03-07",
        "prepTime": prep,
        "description": f" {name} for four ",
    }


def rows():
    return [row(*dish[:4], number) for number, dish in enumerate(DISHES)]


def write_json(folder, records, name="part-0.json"):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)
