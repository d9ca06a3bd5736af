"""Declared input schemas (fixed values of the source formats)."""

TITLE_BASICS = (
    "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult int, "
    "startYear int, endYear string, runtimeMinutes int, genres string"
)
TITLE_CREW = "tconst string, directors string, writers string"
NAME_BASICS = (
    "nconst string, primaryName string, birthYear string, deathYear string, "
    "primaryProfession string, knownForTitles string"
)
MOVIES = "movie_id string, movie_title string, genres string"
USERS = "user_id string, twitter_id string"
RATINGS = "user_id string, movie_id string, rating string, rating_timestamp string"
LINKS = "movieId int, imdbId string, tmdbId string"
TRIPLES = "s string, p string, o string"
ENTITY_INDEX = "id string, entity string"
PERSON_PAYLOAD = (
    "struct<imdb_id: string, tmdb_data: struct<id: int, name: string, original_name: string, "
    "media_type: string, adult: boolean, popularity: double, gender: int, "
    "known_for_department: string, profile_path: string, "
    "known_for: array<struct<id: int, popularity: double>>>>"
)
