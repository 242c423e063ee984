"""Which script or command a process really runs: argument rules by interpreter, rewriting and categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Arguments of one interpreter. ``skips``: options with an argument of their own; ``inline``: letters of a short
    option that says the program is on the command line; ``next_is_script``: letters of one followed by the script."""

    skips: tuple[str, ...] = ()
    inline: str = ""
    next_is_script: str = ""


COMMAND = "COMMAND"
#: Interpreters by the start of the executable's name, and their options.
RULES: dict[str, Rule] = {
    "java": Rule(skips=("-cp",)),
    "python": Rule(skips=("-m", "-Q", "-W"), inline="c"),
    "perl": Rule(inline="eE"),
    "ruby": Rule(skips=("-C", "-F", "-I", "-K", "-r"), inline="e"),
    "bash": Rule(skips=("--rcfile", "--init-file", "-O", "+O"), inline="c"),
    "sh": Rule(skips=("--rcfile", "--init-file", "-O", "+O"), inline="c"),
    "csh": Rule(inline="c", next_is_script="b"),
    "tcsh": Rule(inline="c", next_is_script="b"),
}


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def arguments(cmd_args: Column) -> Column:
    """Pipe-separated arguments as an array."""
    return F.split(cmd_args, "[|]")


def _script(args: Column, rule: Rule) -> Column:
    start = F.struct(F.lit(False).alias("skip"), F.lit(False).alias("take"), F.lit(None).cast("string").alias("found"))

    def step(acc: Column, arg: Column) -> Column:
        state = lambda skip=False, take=False, found=None: F.struct(F.lit(skip).alias("skip"), F.lit(take).alias("take"), (F.lit(None).cast("string") if found is None else found).alias("found"))
        short = lambda letters: arg.rlike(f"^-[A-Za-z]*[{letters}]") if letters else F.lit(False)
        return (
            F.when(acc["found"].isNotNull(), acc)
            .when(acc["take"], state(found=arg))
            .when(acc["skip"], state())
            .when(arg.isin(*rule.skips) if rule.skips else F.lit(False), state(skip=True))
            .when(short(rule.inline), state(found=F.lit(COMMAND)))
            .when(short(rule.next_is_script), state(take=True))
            .when(arg.startswith("-"), state())
            .otherwise(state(found=arg))
        )

    rest = F.slice(args, 2, F.greatest(F.size(args) - 1, F.lit(0)))
    return F.aggregate(rest, start, step, lambda acc: acc["found"])


def script(exe_path: Column, cmd_args: Column, rules: Mapping[str, Rule] = RULES) -> Column:
    """The script that an interpreter runs, COMMAND for a program on the command line, null for other executables."""
    name, args, out = basename(exe_path), arguments(cmd_args), F.lit(None).cast("string")
    for prefix, rule in reversed(list(rules.items())):
        out = F.when(name.startswith(prefix), _script(args, rule)).otherwise(out)
    return out


def first_plain_argument(cmd_args: Column) -> Column:
    """The first argument after the program that is no option."""
    args = arguments(cmd_args)
    return F.get(F.filter(F.slice(args, 2, F.greatest(F.size(args) - 1, F.lit(0))), lambda a: ~a.startswith("-")), 0)


def command(exe_path: Column, script_: Column) -> Column:
    """Name of the script, or of the executable if there is none."""
    return F.when(F.coalesce(script_, F.lit("")).isin("", COMMAND), basename(exe_path)).otherwise(basename(script_))


def rewrite(command_: Column, rules: Sequence[tuple[str | Column, str, str]]) -> Column:
    """Ordered rules (column, regex, replacement): where the regex matches at the start of the column, the command becomes
    that column with all matches replaced. A rule on ``command`` sees what earlier rules made; groups are ``$1``."""
    out = command_
    for source, regex, replacement in rules:
        of = out if source == "command" else F.col(source) if isinstance(source, str) else source
        out = F.when(of.rlike(f"^(?:{regex})"), F.regexp_replace(of, regex, replacement)).otherwise(out)
    return out


def categorize(value: Column, categories: Sequence[tuple[str, Sequence[str]]], other: str | None = None) -> Column:
    """``category_<name>`` of the first category with a regex that matches all of the value; else ``category_<other>``,
    or the value itself."""
    out = F.lit(f"category_{other}") if other else value
    for name, patterns in reversed(list(categories)):
        out = F.when(value.rlike("^(?:" + "|".join(patterns) + ")$"), F.lit(f"category_{name}")).otherwise(out)
    return out


def map_value(value: Column, rules: Sequence[tuple[str, str]], other: str = "Other") -> Column:
    """Label of the first regex found in the value."""
    out = F.lit(other)
    for regex, label in reversed(list(rules)):
        out = F.when(value.rlike(regex), F.lit(label)).otherwise(out)
    return out


def normalize_path(path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Known prefixes replaced, whatever their case."""
    for regex, replacement in rules:
        path = F.regexp_replace(path, f"(?i)^{regex}", replacement)
    return path
