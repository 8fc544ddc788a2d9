"""DataFrame -> DataFrame operators (usable with ``df.transform``)."""
