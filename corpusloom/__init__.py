"""corpusloom: a Spark-native engine that turns text corpora into tokenized,
indexed training datasets (``.bin``/``.idx``) and back.

Everything is expressed with DataFrame / SQL operators; Arrow-batched Python
runs only inside tasks where no built-in expression exists (tokenizer loops,
binary file I/O).
"""

from corpusloom.session import build_session, scratch_dir, prepare_session

__all__ = ["build_session", "scratch_dir", "prepare_session"]
