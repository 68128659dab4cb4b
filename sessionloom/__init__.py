"""User-behaviour analytics as plain PySpark DataFrame operators.

Every operator is a function from DataFrame to DataFrame; nothing runs until the caller
asks for it.  ``operators`` holds the analyses, ``functions`` the column expressions they
are made of, ``sources`` and ``sinks`` the ways in and out, ``plans`` the two complete jobs
and ``streaming`` the ad-click feed.
"""

__version__ = "0.1.0"
