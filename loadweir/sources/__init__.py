"""Sources: everything that turns stored or arriving records into a DataFrame."""
