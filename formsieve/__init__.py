"""formsieve: DataFrame operators that turn the raw output of document readers into trusted, structured records."""
