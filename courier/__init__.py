"""Store-and-forward packets on Spark.

Packets (an attribute map plus a byte payload) wait in a prioritised, expiring
queue, leave it in batches limited by count and bytes, and are delivered in
transactions.  Every operator takes and returns DataFrames.
"""

from courier.config import ClientConfig, Prioritizer, QueueConfig

__all__ = ["ClientConfig", "Prioritizer", "QueueConfig"]
