"""chatsift: Spark-native curation and profiling of chat-training data.

Operators are plain DataFrame/Column transformations meant to be chained
with ``DataFrame.transform``; see README.md for the map of modules.
"""

__version__ = "0.1.0"
