"""Operators of a training-data pipeline for language models; nothing else imports them."""


def queries():
    """Registered queries by name."""
    from pixelweave.llm.registered import QUERIES

    return dict(QUERIES)


def oracle_sql():
    """SQL of the queries that have one."""
    from pixelweave.llm.registered import ORACLES

    return dict(ORACLES)
