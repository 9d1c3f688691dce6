"""DataFrame operators over the ``nodes`` and ``docs`` tables."""
