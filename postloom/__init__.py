"""postloom: turns batches of short, messy posts into a relational dataset, as Spark DataFrame operators."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from postloom.vocabulary import Vocabulary, VocabularyTable, default_vocabulary

__all__ = ["Vocabulary", "VocabularyTable", "default_vocabulary"]

# Task code travels with the job, so workers need not have the package installed.
register_pickle_by_value(sys.modules[__name__])
