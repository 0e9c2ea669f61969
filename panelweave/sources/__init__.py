"""Reading survey files, their catalogue, and storing results."""
