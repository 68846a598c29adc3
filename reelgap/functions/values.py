"""What must equal the source system's lists for equal results."""

from __future__ import annotations

# Language codes and the names they expand to.
LANGUAGES = {
    "hi": "Hindi", "kn": "Kannada", "ml": "Malayalam", "te": "Telugu", "ta": "Tamil", "en": "English", "mr": "Marathi",
    "bn": "Bengali", "pa": "Punjabi", "gu": "Gujarati", "or": "Odia", "ur": "Urdu", "sa": "Sanskrit", "si": "Sinhala",
    "ne": "Nepali", "fr": "French", "de": "German", "es": "Spanish", "ja": "Japanese", "zh": "Chinese", "ko": "Korean",
    "ar": "Arabic", "pt": "Portuguese", "it": "Italian", "ru": "Russian",
}

# Language codes and names spoken in India.
INDIAN_CODES = ["hi", "kn", "te", "ta", "ml", "mr", "bn", "pa", "gu", "or", "bho", "as", "mai", "kok", "sa"]
INDIAN_NAMES = ["Hindi", "Kannada", "Telugu", "Tamil", "Malayalam", "Marathi", "Bengali", "Punjabi", "Gujarati", "Odia", "Bhojpuri", "Assamese", "Maithili", "Konkani", "Sanskrit"]

# Other languages: code, name, ISO country code, country.
COUNTRIES = [
    ("ur", "Urdu", "PK", "Pakistan"), ("en", "English", "US", "United States"), ("fr", "French", "FR", "France"),
    ("de", "German", "DE", "Germany"), ("ja", "Japanese", "JP", "Japan"), ("ko", "Korean", "KR", "South Korea"),
    ("zh", "Chinese", "CN", "China"), ("es", "Spanish", "ES", "Spain"), ("pt", "Portuguese", "BR", "Brazil"),
    ("it", "Italian", "IT", "Italy"), ("ru", "Russian", "RU", "Russia"), ("ar", "Arabic", "SA", "Saudi Arabia"),
    ("si", "Sinhala", "LK", "Sri Lanka"), ("ne", "Nepali", "NP", "Nepal"), ("th", "Thai", "TH", "Thailand"),
    ("tr", "Turkish", "TR", "Turkey"), ("id", "Indonesian", "ID", "Indonesia"), ("vi", "Vietnamese", "VN", "Vietnam"),
    ("nl", "Dutch", "NL", "Netherlands"), ("pl", "Polish", "PL", "Poland"), ("sv", "Swedish", "SE", "Sweden"),
    ("da", "Danish", "DK", "Denmark"), ("fi", "Finnish", "FI", "Finland"), ("nb", "Norwegian", "NO", "Norway"),
    ("cs", "Czech", "CZ", "Czech Republic"), ("hu", "Hungarian", "HU", "Hungary"), ("ro", "Romanian", "RO", "Romania"),
    ("he", "Hebrew", "IL", "Israel"),
]

# Languages of the films that the third source covers.
INDIAN_FILM_LANGUAGES = [
    "hindi", "tamil", "telugu", "malayalam", "kannada", "bengali", "marathi", "punjabi", "gujarati", "odia", "oriya",
    "urdu", "assamese", "bhojpuri", "nepali", "rajasthani", "rajastani", "tulu", "sanskrit", "konkani", "kashmiri",
]

# Headers of film files.
NAME_HEADERS = {"movie name", "movie", "film", "title", "name"}
SKIPPED_HEADERS = {"overview", "description", "tagline", "backdrop_path", "poster_path", "homepage", "originaltitle", "rating", "releasedate"}
RENAMED_HEADERS = {"year": "release_date", "release_date": "release_date", "vote_average": "rating_10", "vote_count": "votes", "original_language": "language"}
RENAMED_SLUGS = {"grossworldwide": "revenue", "gross_worldwide": "revenue", "worldwide": "revenue", "timing_min": "runtime"}
KNOWN_NUMERIC = {"gdp_usd_billions", "inflation_rate_pct"}

# Headers of cast files, by field.
CAST_HEADERS = {
    "movie": {"name", "movie name", "movie", "film", "title", "film name", "movie title"},
    "year": {"year", "release year", "release_year", "released", "release date", "release_date", "date"},
    "genre": {"genre", "genres", "category", "categories"},
    "director": {"director", "directed by", "directors"},
    "rating": {"rating", "imdb rating", "imdb_rating", "score", "imdb score", "vote_average", "rating_10"},
    "votes": {"votes", "vote_count", "num votes", "num_votes", "number of votes"},
    "runtime": {"duration", "runtime", "runtime (min)", "duration (min)", "length", "timing_min"},
    "language": {"language", "languages", "original_language", "lang"},
}
ACTOR_HEADER = r"(?i)^(?:actor|cast|star|lead actor|supporting actor)\s*(\d+)?$"


def resolver() -> list[tuple[str, str, str]]:
    """(language code or name in lower case, ISO country code, country)."""
    rows = [(x.lower(), "IN", "India") for x in [*INDIAN_CODES, *INDIAN_NAMES]]
    for code, name, iso, country in COUNTRIES:
        rows += [(code, iso, country), (name.lower(), iso, country)]
    return rows


def countries() -> list[tuple[str, str]]:
    """(ISO country code, country), each once."""
    return sorted({(iso, country) for _, iso, country in resolver()})
