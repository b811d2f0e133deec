"""Web-address risk analytics as DataFrame programs."""
