"""Raw and cleaned tables for one data folder, built once per call site.

Every property is a lazy DataFrame, except the ``_saved`` ones, which run once
and write their rows to the checkpoint folder.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from itemscope.operators import clean as C
from itemscope.operators import features as FE
from itemscope.session import ensure_checkpoint_dir
from itemscope.sources import fixtures as FX


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # raw roles
    @cached_property
    def movies(self) -> DataFrame:
        return FX.movies(self.spark, self.sf_dir)

    @cached_property
    def ratings(self) -> DataFrame:
        return FX.ratings(self.spark, self.sf_dir)

    @cached_property
    def tags(self) -> DataFrame:
        return FX.tags(self.spark, self.sf_dir)

    @cached_property
    def links(self) -> DataFrame:
        return FX.links(self.spark, self.sf_dir)

    @cached_property
    def genome_scores(self) -> DataFrame:
        return FX.genome_scores(self.spark, self.sf_dir)

    @cached_property
    def genome_tags(self) -> DataFrame:
        return FX.genome_tags(self.spark, self.sf_dir)

    def raw(self, name: str) -> DataFrame:
        return getattr(self, name)

    # cleaned tables
    @cached_property
    def catalog(self) -> DataFrame:
        return C.clean_catalog(self.movies, self.links)

    @cached_property
    def ratings_clean(self) -> DataFrame:
        return C.clean_interactions(self.ratings)

    @cached_property
    def tags_clean(self) -> DataFrame:
        return C.clean_tags(self.tags)

    @cached_property
    def item_genres(self) -> DataFrame:
        return C.item_categories(self.catalog)

    @cached_property
    def feature_frame(self) -> DataFrame:
        return FE.feature_frame(self.catalog, self.ratings_clean, self.tags_clean, self.item_genres)

    @cached_property
    def item_tokens_saved(self) -> DataFrame:
        """The (item, token) pairs written once to the checkpoint folder: the
        vocabulary, the indicators and the counts per item all read them."""
        ensure_checkpoint_dir(self.spark)
        return FE.item_tokens(self.tags_clean, self.catalog).checkpoint(eager=True)

    @cached_property
    def model_frame_saved(self) -> DataFrame:
        """The model frame written once to the checkpoint folder: the scaling
        statistics and the matrix read it."""
        ensure_checkpoint_dir(self.spark)
        return FE.model_frame(self.catalog, self.ratings_clean, self.item_tokens_saved, self.item_genres).checkpoint(eager=True)

    @cached_property
    def tags_events(self) -> DataFrame:
        return FX.tags_events(self.spark, self.sf_dir)
