"""episodic: Spark-native tutoring / subscription analytics.

Every public function takes and returns DataFrames, takes its reference
time (``as_of``) explicitly and runs inside the JVM (no Python UDFs).
"""

from episodic.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
