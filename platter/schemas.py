"""Column lists and schemas of the library's tables."""

RAW_REVIEW = (
    "id string, artist string, title string, url string, date string, releaseYear int, originalYear int, score double, "
    "genres array<string>, reviewer string, bnm boolean, bnr boolean, description string, image string"
)
ENRICHMENT = "map<string, struct<country: string, language: string, mbid: string>>"
REVIEW = (
    "id string, artist string, album string, score double, review_date string, review_year int, release_year int, "
    "original_year int, genres string, genre string, reviewer string, bnm boolean, bnr boolean, is_new_release boolean, "
    "is_reissue boolean, country string, language string, mbid string, blurb string, url string, image string, _key string"
)
REVIEW_COLUMNS = [field.split()[0] for field in REVIEW.split(", ")]
EXTRACTION = (
    "capture_file string, capture_timestamp string, review_date_approx string, extractor string, extractor_idx int, pos int, "
    "artist string, album string, score double, reviewer string, blurb string, label string"
)
GENRE_SEPARATOR = "; "
