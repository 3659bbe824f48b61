"""Column functions shared by every job."""
