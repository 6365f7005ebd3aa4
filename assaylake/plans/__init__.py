"""Views, reports, loop drivers and the registered queries."""
