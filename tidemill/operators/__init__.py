"""Row and set operators, each a plain ``DataFrame -> DataFrame`` function."""
