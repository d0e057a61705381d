"""Declared schemas of the seven extracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Dataset:
    name: str
    file_name: str
    ddl: str
    key: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def header(self) -> str:
        return "\t".join(self.columns)


# Column names, order and types as published.
DATASETS = {d.name: d for d in (
    Dataset("title_basics", "title.basics.tsv.gz",
            "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult string, "
            "startYear int, endYear int, runtimeMinutes int, genres string", ("tconst",)),
    Dataset("title_akas", "title.akas.tsv.gz",
            "titleId string, ordering int, title string, region string, language string, types string, "
            "attributes string, isOriginalTitle boolean", ("titleId", "ordering")),
    Dataset("title_ratings", "title.ratings.tsv.gz",
            "tconst string, averageRating decimal(3,1), numVotes int", ("tconst",)),
    Dataset("name_basics", "name.basics.tsv.gz",
            "nconst string, primaryName string, birthYear int, deathYear int, primaryProfession string, "
            "knownForTitles string", ("nconst",)),
    Dataset("title_crew", "title.crew.tsv.gz",
            "tconst string, directors string, writers string", ("tconst",)),
    Dataset("title_episode", "title.episode.tsv.gz",
            "tconst string, parentTconst string, seasonNumber int, episodeNumber int", ("tconst",)),
    Dataset("title_principals", "title.principals.tsv.gz",
            "tconst string, ordering int, nconst string, category string, job string, characters string"),
)}
